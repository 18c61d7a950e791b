"""SimHash links: fingerprints by a plain count, links by brute force over all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pageloom.llm import simhash_join as SH
from pageloom.llm.queries import QUERIES

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_code(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    runs = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(codes, distance=4):
    """The least position of each code's component."""
    root = list(range(len(codes)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    every = np.array(codes, np.uint64)
    for k in range(len(codes)):
        for other in np.flatnonzero(np.bitwise_count(every[:k] ^ every[k]) <= distance).tolist():
            a, b = top(k), top(other)
            root[max(a, b)] = min(a, b)
    return [top(k) for k in range(len(codes))]


def clustered_codes(dice, n, centres, loose):
    out = []
    for _ in range(centres):
        centre, some = dice.getrandbits(64), dice.sample(range(64), loose)
        out += [centre ^ sum(1 << b for b in some if dice.random() < 0.5) for _ in range(n // centres)]
    return list(dict.fromkeys(out))


def test_fingerprints_equal_plain_counts(spark, sf, monkeypatch):
    monkeypatch.setattr(SH, "_HASHES_AT_ONCE", 7)
    texts = [None, "", " \n", "One", "a b c", "A B c D", "x  y\tz\n w ñandú É 日本 😀 ", "rep " * 40, "tail  "]
    texts += [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").limit(25).collect()]
    data = "".join(t or "" for t in texts).encode()
    offsets = np.cumsum([0, *(len((t or "").encode()) for t in texts)])
    found = SH.codes_of(np.frombuffer(data, np.uint8), offsets)
    assert found.tolist() == [brute_code(t) for t in texts]


def test_gray_rank():
    codes = np.arange(64, dtype=np.uint64)
    order = codes[np.argsort(SH.gray_rank(codes))]
    assert (np.bitwise_count(order[1:] ^ order[:-1]) == 1).all()
    dice = random.Random(1)
    assert len(set(SH.gray_rank(np.array([dice.getrandbits(64) for _ in range(900)], np.uint64)).tolist())) == 900


@pytest.mark.parametrize("parts", [5, 6, 7, 8])
def test_linked_codes_agree_in_one_table(parts):
    dice = random.Random(parts)
    a = np.array([dice.getrandbits(64) for _ in range(300)], np.uint64)
    b = a ^ np.array([sum(1 << k for k in dice.sample(range(64), 4)) for _ in a], np.uint64)
    met = np.zeros(len(a), dtype=bool)
    for front in SH.tables(parts, 4):
        x, y = SH.arranged(a, parts, front), SH.arranged(b, parts, front)
        assert (np.bitwise_count(x ^ y) == 4).all() and (np.bitwise_count(x) == np.bitwise_count(a)).all()
        free = np.uint64(64 - SH.key_bits(parts, front, 4))
        met |= x >> free == y >> free
        assert ((SH.gray_rank(x) >> free == SH.gray_rank(y) >> free) == (x >> free == y >> free)).all()
    assert met.all()


def test_part_count_grows_with_the_table():
    assert [SH.part_count(n, 4) for n in (0, 10**6, 10**7, 10**9, 10**12)] == [5, 5, 6, 7, 8]


@pytest.mark.parametrize("seed", range(5))
def test_block_forest_equals_brute_force(seed, monkeypatch):
    monkeypatch.setattr(SH, "_AT_ONCE", 50)
    dice = random.Random(seed)
    blocks = [clustered_codes(dice, dice.choice([1, 9, 150]), dice.choice([1, 5]), dice.choice([0, 6, 14, 30])) for _ in range(4)]
    blocks = [sorted(b, key=lambda c: int(SH.gray_rank(np.array([c], np.uint64))[0])) for b in blocks if b]
    starts = np.cumsum([0, *(len(b) for b in blocks)])[:-1]
    found = SH.block_forest(np.array([c for b in blocks for c in b], np.uint64), starts, 4).tolist()
    wanted = [b[k] for b in blocks for k in brute_components(b)]
    assert found == wanted


@pytest.mark.parametrize(("block", "group", "loose"), [(2_048, 256, 12), (16, 256, 12), (8, 256, 40), (5, 0, 20)])
def test_links_across_blocks(spark, block, group, loose):
    dice = random.Random(block)
    codes = clustered_codes(dice, 500, 4, loose) + [dice.getrandbits(64) for _ in range(100)]
    codes += [c ^ 1 << dice.randrange(64) for c in codes[:60]]
    codes = list(dict.fromkeys(codes))
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    table = spark.createDataFrame([(c,) for c in signed], "code long")
    labels = SH.linked_codes(table, block=block, group=group)
    comp = {r["node"]: r["comp"] for r in labels.collect()}
    place = brute_components(codes)
    groups, wanted = {}, {}
    for k, c in enumerate(signed):
        groups.setdefault(comp.get(c, c), set()).add(c)
        wanted.setdefault(place[k], set()).add(c)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_rows(spark):
    base = " ".join(f"w{k}" for k in range(400))
    rows = [
        (9, base, 1),
        (3, base.upper(), 2),
        (5, base.replace("w7 ", "other "), 3),
        (None, base + " end", 4),
        (4, None, 5),
        (2, " \n", 6),
        (8, "", 7),
        (None, None, 8),
        (11, "One two", 9),
        (11, "One two", 9),
        (None, "alone in the world with these words", 10),
        (12, "x " * 100_000, 11),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int").withColumn("fingerprint", F.lit("old"))
    found = SH.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    got = sorted(map(repr, (tuple(r) for r in found)))
    codes = [brute_code(r[1]) for r in rows]
    place = brute_components(codes)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[place[k]] = min(least.get(place[k], r[0]), r[0])
    assert got == sorted(repr((r[0], f"{c:016x}", least.get(p))) for r, c, p in zip(rows, codes, place))
    assert least[place[0]] == 3 and least[place[4]] == 2
    assert SH.near_duplicates(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    codes = [brute_code(r["text"]) for r in docs]
    place = brute_components(codes)
    wanted = {(r["doc_id"], f"{c:016x}", docs[p]["doc_id"]) for r, c, p in zip(docs, codes, place)}
    assert {tuple(r) for r in QUERIES["op12_simhash_near_dedup"](spark, sf).collect()} == wanted
    assert len({w[2] for w in wanted}) < len(wanted)
