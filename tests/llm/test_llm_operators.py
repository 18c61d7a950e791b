"""Operators on small tables: odd rows, empty tables, clashing columns, brute force."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path
from urllib.parse import urlparse

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from pageloom.llm import decontaminate as DC
from pageloom.llm import html_text as H
from pageloom.llm import language as L
from pageloom.llm import language_model as LM
from pageloom.llm import mixing as MX
from pageloom.llm import ngram_join as NG
from pageloom.llm import quality as QU
from pageloom.llm import token_counts as TC
from pageloom.llm import toxicity as TO
from pageloom.llm import url_filter as U
from pageloom.llm.components import components
from pageloom.llm.counting import value_counts
from pageloom.llm.queries import QUERIES, SQL, URL_RULES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, score string, hits int, n_words string"
LONG = " ".join(f"w{k % 977} the" for k in range(30_000))
ODD = [
    (1, None, None, None, 0, "x", 1, "y"),
    (2, "", "en", "a", 0, "x", 1, "y"),
    (3, " \t\n ", "en", "a", 0, "x", 1, "y"),
    (4, "one", None, "a", 0, "x", 1, "y"),
    (5, "One", "en", "b", 0, "x", 1, "y"),
    (6, "123 !!! ###", "en", None, 0, "x", 1, "y"),
    (7, LONG, "en", "a", 0, "x", 1, "y"),
    (7, LONG, "en", "a", 0, "x", 1, "y"),
    (None, "no id at all but enough words to be a text of its own", "en", "a", 0, None, None, None),
    (None, None, None, None, None, None, None, None),
    (8, "ñandú été 日本語 😀 " * 20, "fr", "b", 0, "x", 1, "y"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SHAPE)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SHAPE)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(name, spark, sf):
    engine = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        engine.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
    found, wanted = QUERIES[name](spark, sf), engine.sql(SQL[name])
    order = sorted(found.columns)
    assert order == sorted(wanted.columns)
    pick = lambda columns, all_rows: sorted(repr([r[columns.index(c)] for c in order]) for r in all_rows)
    assert pick(found.columns, rows(found)) == pick(list(wanted.columns), wanted.fetchall())


@pytest.mark.parametrize("width", [1, 2, 3, 4, 5, 10])
def test_blocks_meet_all_windows(width):
    dice = random.Random(width)
    for _ in range(150):
        items = [(str(k), " ".join(dice.choices("abc", k=dice.randint(0, 3 * width)))) for k in range(4)]
        text = dice.choices("abcd", k=dice.randint(0, 40)) + dice.choice(items)[1].split() + dice.choices("abcd", k=3)
        matcher = DC.Matcher(DC.Slot.of(items), width)
        runs, met = matcher.scan(np.array([matcher.known.get(w.encode(), 0) for w in text], np.int32))
        hit, ids = set(), set()
        for k, (_, body) in enumerate(items):
            own = body.split()
            n = min(width, len(own))
            for a in range(len(own) - n + 1 if n else 0):
                for b in range(len(text) - n + 1):
                    if text[b : b + n] == own[a : a + n]:
                        hit.update(range(b, b + n))
                        ids.add(k)
        assert {w for a, b in runs for w in range(a, b)} == hit and met == ids
        assert all(x[1] < y[0] for x, y in zip(runs, runs[1:]))


@pytest.mark.parametrize("words", [100, 20_000, 700_000])
def test_lexicons_of_any_size(words):
    slot = DC.Slot.of([(k, " ".join(f"w{i:x}" for i in range(k * 100, k * 100 + 100))) for k in range(words // 100)])
    matcher = DC.Matcher(slot, 10)
    some = words - 100 + np.arange(1, 101, dtype=np.int32)
    assert matcher.scan(np.concatenate([[0, 0], some[5:40], [0]]).astype(np.int32)) == ([(2, 37)], {words // 100 - 1})
    assert matcher.scan(some[::-1].copy()) == ([], set()) and matcher.scan(some[:9]) == ([], set())


def test_matchers_are_told_apart_by_their_items():
    class Sent:
        def __init__(self, items):
            self.value = DC.Slot.of(items)

    for k in range(50):  # lists that are freed lend their identity to new ones
        sent = Sent([(k, f"item{k}")])
        assert b"item%d" % k in DC._matcher(sent, sent.value.digest, 10).known
    assert DC.Slot.of([(1, "a b")]).digest != DC.Slot.of([(1, "a"), (None, "b")]).digest != DC.Slot.of([(2, "a b")]).digest


# --- 10 --------------------------------------------------------------------------------


def test_url_verdicts(spark):
    urls = [
        ("http://A.net/x", "a.net", "/x", "net/", "block"),
        ("https://www.example.net/en/1?q=xxx", "www.example.net", "/en/1", "example.net/en/", "allow"),
        ("https://xnet/", "xnet", "/", None, "allow"),
        ("http://net", "net", "", None, "allow"),
        ("http://a.org/fr/casino", "a.org", "/fr/casino", "org/fr/", "allow"),
        ("http://a.org/casino", "a.org", "/casino", None, "block"),
        ("http://a.org/casinos", "a.org", "/casinos", None, "allow"),
        ("http://a.org/free", "a.org", "/free", None, "allow"),
        ("http://a.org/free/free", "a.org", "/free/free", None, "allow"),
        ("http://a.org/FREE?win=1", "a.org", "/FREE", None, "block"),
        ("no scheme casino", "", "", None, "block"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(k, u[0], "old", "old") for k, u in enumerate(urls)], "page_id int, url string, host string, verdict string")
    found = U.url_verdicts(pages, URL_RULES).orderBy("page_id")
    assert [(r["url"], r["host"], r["path"], r["rule"], r["verdict"]) for r in found.collect()] == urls
    assert U.url_verdicts(pages.limit(0), URL_RULES).count() == 0
    assert U.url_verdicts(pages).filter("rule is not null").count() == 0


# --- 3 ---------------------------------------------------------------------------------


def brute_contamination(text, items):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(FOLD))
    words, hit, met = find(text), set(), set()
    for item, body in items:
        own = find(body)
        n = min(10, len(own))
        for k in range(len(own) - n + 1 if n else 0):
            for at in range(len(words) - n + 1):
                if words[at : at + n] == own[k : k + n]:
                    hit.update(range(at, at + n))
                    met.add(str(item))
    ids = ",".join(sorted(m for m in met if m != "None"))
    return len(words), len(hit), len(met), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("slot_words", [10**6, 25])
def test_contamination(spark, odd, none, slot_words):
    items = [(10, "a b c d e f g h i j k l"), (9, "Short Item"), (2, "été 日本語"), (3, None), (4, " ... "), (9, "Short Item"), (11, "a b c d e f g h i j"), (None, "d e f g h i j k"), (None, "shorty")]
    tests = spark.createDataFrame(items, "item_id long, text string")
    dice = random.Random(1)
    texts = [" ".join(dice.choices("abcdefghijkl", k=12)) for _ in range(5)]
    texts += ["x A-B, c d e f g h i J! k l y", "short, item short item", "shorty item", "b c d e f g h i j k a b c d e f g h i j", "a b c d e f g h i"]
    docs = spark.createDataFrame([(100 + k, t) for k, t in enumerate(texts)], "doc_id long, text string").unionByName(odd.select("doc_id", "text"))
    found = DC.contamination(docs, tests, slot_words=slot_words).collect()
    got = sorted((repr(r["text"]), *tuple(x)[1:]) for r, x in zip(found, DC.digest(DC.contamination(docs, tests, slot_words=slot_words)).collect()))
    assert got == sorted((repr(r["text"]), *brute_contamination(r["text"], items)) for r in docs.collect())
    for r in found:
        raw = (r["text"] or "").encode()
        for h in r["hits"]:
            assert len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", raw[h["start"] : h["end"]].decode().translate(FOLD))) == h["last"] - h["first"]
    assert all(r["items"] == sorted(r["items"], key=lambda i: (i is None, i or "")) for r in found)
    assert DC.contamination(none, tests).count() == 0
    assert DC.contamination(odd, tests.limit(0)).filter(F.size("hits") > 0).count() == 0
    assert DC.contamination(odd, tests).columns.count("hits") == 1


# --- 5 ---------------------------------------------------------------------------------


def test_mix(spark, sf, odd, none):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source")
    found = MX.mix(docs, block_words=500, shard_words=5_000).collect()
    assert sorted(found) == sorted(MX.mix(docs.repartition(7), block_words=500, shard_words=5_000).collect())
    sizes = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in docs.collect()}
    by_source = defaultdict(list)
    for r in found:
        assert r["size"] == sizes[r["doc_id"]] and r["taken"] == r["size"] * len(r["draws"]) <= 2 * r["size"]
        by_source[r["source"]].append(r)
    names = sorted(by_source)
    total = [sum(r["size"] for r in by_source[s]) for s in names]
    targets = MX.source_targets(total, [MX.cycled_weight(k) for k in range(len(names))], 1.5, 2)
    for name, size, target in zip(names, total, targets):
        own = by_source[name]
        assert {(r["source_size"], round(r["target"], 6)) for r in own} == {(size, round(target, 6))}
        assert abs(sum(r["taken"] for r in own) - target) <= max(r["size"] for r in own)
    shards = Counter()
    for r in found:
        for d in r["draws"]:
            shards[d["shard"]] += r["size"]
    assert len(shards) == math.ceil(sum(targets) / 5_000)
    strange = MX.mix(odd).collect()
    assert len(strange) == len(ODD) and all(r["size"] == len(WORD.findall(text or "")) for r, text in [(r, None) for r in strange if r["doc_id"] == 1])
    assert MX.mix(none).count() == 0


def test_shuffled_shards(spark, sf, odd):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = MX.shuffled_shards(docs, block_words=500, shard_words=5_000)
    drawn = MX.mix(docs, block_words=500, shard_words=5_000)
    count = {r["doc_id"]: r["count"] for r in found.groupBy("doc_id").count().collect()}
    assert count == {r["doc_id"]: len(r["draws"]) for r in drawn.collect() if r["draws"]}
    top = found.groupBy("shard").agg(F.max("position").alias("last"), F.count("*").alias("n"), F.countDistinct("position").alias("d"))
    assert top.filter("last <> n or n <> d").count() == 0
    assert MX.shuffled_shards(odd).columns == [*odd.columns, "shard", "pass", "position"]


# --- 6 ---------------------------------------------------------------------------------


def brute_components(docs):
    sets = {}
    for key, text in docs:
        words = WORD.findall((text or "").translate(FOLD))
        sets[key] = {tuple(words[k : k + 3]) for k in range(len(words) - 2)} if len(words) > 2 else {tuple(words)} if words else set()
    root = {k: k for k in sets}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 90 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), top(k)) for k in keys}


def near_copies(seed):
    dice = random.Random(seed)
    lexicon = ["".join(dice.choices("abcdefgh", k=3)) for _ in range(300)]
    passage = dice.choices(lexicon, k=50)
    docs = []
    for n in (12, 30, 60, 130, 400):
        base = dice.choices(lexicon, k=n)
        for _ in range(25):
            own = base.copy()
            for _ in range(dice.randint(0, max(1, n // 25))):
                own[dice.randrange(len(own))] = dice.choice(lexicon)
            docs.append(own)
    docs += [dice.choices(lexicon, k=dice.randint(1, 90)) + passage for _ in range(40)]
    docs += [passage + [w] for w in lexicon[:20]] + [[w] for w in lexicon[:5]] * 2 + [lexicon[:2]] * 3 + [[], []]
    dice.shuffle(docs)
    return [(k, dice.choice((" ", "\n", "  ")).join(w).title() if k % 3 else " ".join(w)) for k, w in enumerate(docs)]


@pytest.mark.parametrize("block", [6, 192])
def test_linked_documents(spark, block):
    docs = near_copies(block) + [(-1, None)]
    found = NG.linked_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), block=block, pivot_least=2 * block).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_components(docs)
    assert len({r["component_id"] for r in found}) < len(docs) - 60


def test_linked_odd_documents(odd, none):
    found = sorted(rows(NG.linked_documents(odd)), key=repr)
    assert [r for r in found if r[0] in (4, 5)] == [(4, 1, 4), (5, 1, 4)]
    assert [r[2] for r in found if r[0] in (1, 2, 3, 7)] == [1, 2, 3, 7, 7] and len(found) == len(ODD)
    assert [r[1] for r in found if r[0] in (1, 2, 3)] == [0, 0, 0]
    assert NG.linked_documents(none).count() == 0


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    found = set()
    while files.hasNext():
        found.add(files.next().getName())
    return {f for f in found if f.startswith("shuffle_")}


def test_linked_documents_leave_few_files(spark):
    """What the steps shuffle and keep goes with them, not when the driver happens to collect its garbage."""
    docs = near_copies(3)
    folder = Path(urlparse(spark.sparkContext.getCheckpointDir()).path)
    tables, shuffled = set(folder.iterdir()), shuffle_files(spark)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    found = NG.linked_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), block=6, pivot_least=12)
    # Rows and components, and the labels of two turns and of the cells.
    assert 2 <= len(set(folder.iterdir()) - tables) <= 5
    for _ in range(100):  # files are deleted in the background
        if not (left := shuffle_files(spark) - shuffled):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(setting) == before
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()} == brute_components(docs)


def test_first_rows_of_nodes_with_equal_flags(spark):
    rows = [(0, [5, 6], 0), (1, [7], 1), (-1, [5], 2), (0, [5, 6], 3), (None, [], 4), (2, [], 5), (1 << 60, [8], 6), (-1, [5], 7)]
    nodes = [(0, 0, 2), (1, 1, 1), (-1, 2, 2), (2, 5, 1), (1 << 60, 6, 1)]
    index = spark.createDataFrame(rows, "node long, sigs array<long>, key long").repartition(3)
    found = NG.first_rows(index, spark.createDataFrame(nodes, "node long, key long, copies long")).collect()
    assert sorted(map(tuple, found)) == [(-1, [5]), (0, [5, 6]), (1, [7]), (1 << 60, [8])]


def test_components(spark):
    dice = random.Random(4)
    edges = [(k, k + 1) for k in range(40)] + [(100 + dice.randrange(50), 100 + dice.randrange(50)) for _ in range(40)] + [(7, 7)]
    found = {r["node"]: r["comp"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {n: n for e in edges for n in e}
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert found == {n: r for n, r in root.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_few_edges_are_few_files(spark):
    """A file a partition costs commands on a local file system; edges are worked out once."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    settings = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        edges = spark.range(40).selectExpr("id AS a", "id + 1 AS b").mapInArrow(counted, "a long, b long")
        found = components(edges)
        assert found.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
        assert {(r["node"], r["comp"]) for r in found.collect()} == {(k, 0) for k in range(41)}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert read.value == 40


# --- 7 ---------------------------------------------------------------------------------


def brute_statistics(text):
    text = text or ""
    words, seen, doubled = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            doubled += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {k + j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), doubled, len(covered)


def test_quality(spark, sf, odd, none, labels):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    found = QU.judge(docs, QU.fit_quality(docs, spark.read.parquet(f"{sf}/labels.parquet")), keep_text=True).collect()
    assert len(found) == docs.count()
    for r in found:
        own = brute_statistics(r["text"])
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == own
        assert r["base_failed"] == (own[0] < 10 or 100 * own[4] > 20 * own[0]) and not (r["kept"] and r["base_failed"])
    plain = QU.judge(odd, QU.fit_quality(odd, labels))
    assert plain.filter("kept = base_failed").count() == 0 and plain.columns.count("n_words") == 1
    assert QU.judge(none, None).count() == 0


def thue_morse(size):
    """Two different strings whose polynomial hashes modulo 2^64 agree from 1,024 letters on."""
    word = "".join("ab"[k.bit_count() % 2] for k in range(size))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_long_words_and_lines_are_told_apart(spark):
    pairs = [thue_morse(n) for n in (500, 511, 512, 1_024, 2_048, 4_096)]
    lines = spark.createDataFrame([(k, f"{a}\n{b}\n{a}") for k, (a, b) in enumerate(pairs)], "doc_id long, text string")
    for r in QU.document_statistics(lines, keep_text=True).collect():
        assert r["n_dup_lines"] == 1 and r["n_words"] == 3
    docs = [(10 * k + i, w) for k, pair in enumerate(pairs) for i, w in enumerate([*pair, pair[0].upper()])]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in NG.linked_documents(table).collect()}
    assert found == brute_components(docs)
    scores = LM.score_texts(table, F.col("doc_id") % 10 == 0).collect()
    assert {r["doc_id"]: r["n_known"] for r in scores} == {k: 1 + (k % 10 != 1) for k, _ in docs}


def test_value_counts_combine_hot_values(spark):
    rows = spark.range(0, 40_000, 1, 7)

    def values(batch):
        k = batch.column("id").to_numpy().astype(np.uint64)
        yield np.concatenate([k % np.uint64(3), k << np.uint64(40), k // np.uint64(2) << np.uint64(41)])

    wanted = Counter()
    for k in range(40_000):
        wanted.update([k % 3, k << 40, k // 2 << 41])
    found = {r["value"] % (1 << 64): r["n"] for r in value_counts(rows, values, 2).collect()}
    assert found == {v: n for v, n in wanted.items() if n > 1}
    assert value_counts(rows.limit(0), values, 1).count() == 0


# --- 4 and 2 ---------------------------------------------------------------------------


def test_language(spark, sf, odd, none):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = L.train(docs)
    found = L.identify(docs, model).withColumn("out", F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    right = found.filter("out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert right > 0.95
    strange = {(r["doc_id"], r["text"]): r for r in L.identify(odd, model).collect()}
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for (k, _), r in strange.items() if k in (1, 2, 3, 6))
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in ("en", "de", "fr", "es") for (k, _), r in strange.items() if k in (4, 5, 7, 8))
    assert L.train(none) is None and L.identify(odd, None).filter("lang_pred <> 'und'").count() == 0
    assert L.identify(none, model).count() == 0 and L.identify(odd, model).columns.count("score") == 1


def test_toxicity(spark, sf, odd, none, labels):
    docs, marks = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    tagger = TO.train(docs, marks)
    found = TO.score(docs, tagger).join(marks, "doc_id").collect()
    hot = [r["score"] for r in found if r["toxic"] == 1]
    cold = [r["score"] for r in found if r["toxic"] == 0]
    assert sum(h > c for h in hot for c in cold) > 0.8 * len(hot) * len(cold)
    strange = TO.score(odd, tagger).collect()
    assert len(strange) == len(ODD) and all(0 <= r["score"] <= 1 for r in strange) and all(not r["toxic_spans"] for r in strange if not r["text"])
    assert TO.train(odd, labels) is None and TO.score(odd, None).filter("score <> 0").count() == 0
    assert TO.score(none, tagger).count() == 0


# --- 1 ---------------------------------------------------------------------------------


def test_main_text(spark):
    page = "<html><body><nav><a href=/>Home</a> <a href=/b>More</a></nav><div class=ad>Buy now.</div><article><h1>The title of it</h1><p>First words of the article, and more of them. Then a second sentence.<p>Second paragraph &amp; its   text.</article><footer>&copy; somebody</footer>"
    table = [(1, page), (2, None), (3, ""), (4, "<script>x</script>"), (5, "<p>" * 3_000), (1, page)]
    found = H.main_text(spark.createDataFrame([(*r, "old") for r in table], "page_id long, html string, text string")).orderBy("page_id").collect()
    text = "The title of it\n\nFirst words of the article, and more of them. Then a second sentence.\n\nSecond paragraph & its text."
    assert [(r["page_id"], r["text"], r["n_chars"]) for r in found] == [(1, text, len(text))] * 2 + [(k, "", 0) for k in (2, 3, 4, 5)]
    assert H.main_text(spark.createDataFrame([], "page_id long, html string")).count() == 0


# --- 8 ---------------------------------------------------------------------------------


def test_token_counts(spark, odd, none):
    tokenizer = TC.Tokenizer(open(TC.VOCABULARY, "rb").read())
    found = TC.edited_counts(odd.select("doc_id", "text"), edited=True).collect()
    assert len(found) == len(ODD) and all(r["n_tokens_after"] == tokenizer.total(r["text_after"]) for r in found)
    lists = [(1, "mail me at a.b@c.org or call 030 1234 5678 today", None), (2, "abc def", [(0, 3, "x"), (1, 99, None), (-4, 0, "yy ")]), (3, None, [(0, 0, "new text")])]
    docs = spark.createDataFrame(lists, "doc_id long, text string, edits array<struct<start:int,end:int,new:string>>")
    given = TC.edited_counts(docs, edits="edits", edited=True).orderBy("doc_id").collect()
    assert [r["text_after"] for r in given] == [lists[0][1], "yy x", "new text"]
    odd_edits = [(1, "some words here", [(None, 4, "any"), None, (8, None, "x"), (3, 1, None)])]
    shape = "doc_id long, text string, edits array<struct<start:int,end:int,new:string>>"
    odd_row = TC.edited_counts(spark.createDataFrame(odd_edits, shape), edits="edits", edited=True).first()
    assert odd_row["n_edits"] == 3 and odd_row["text_after"].startswith("any wor")
    own = TC.edited_counts(docs.drop("edits"), edited=True).orderBy("doc_id").collect()
    assert own[0]["text_after"] == "mail me at [address] or call [number] today" and own[0]["n_edits"] == 2
    for r in (*given, *own):
        assert r["n_tokens_after"] == tokenizer.total(r["text_after"])
    assert TC.edited_counts(none.select("doc_id", "text")).count() == 0


# --- 9 ---------------------------------------------------------------------------------


def test_model_scores(spark, sf, odd, none):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(odd.filter("doc_id is not null").select(F.col("doc_id") + 10**6, "text").toDF("doc_id", "text"))
    training = F.crc32(F.col("doc_id").cast("string")) % 10 != 0
    found = LM.score_texts(docs, training).collect()
    tokens = [(r["doc_id"], WORD.findall((r["text"] or "").translate(FOLD)) + [""]) for r in docs.collect()]
    counts = Counter(w for k, t in tokens if zlib.crc32(str(k).encode()) % 10 for w in t)
    total, norm = sum(counts.values()), math.log10(sum(counts.values()) + 0.1 * (len(counts) + 1))
    wanted = sorted((k, len(t), sum(w in counts for w in t), total, round(sum(math.log10(counts[w] + 0.1) - norm for w in t), 5)) for k, t in tokens)
    assert sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in found) == wanted
    held = [r for r in found if not r["training"]]
    assert sum(r["score"] for r in held) > 1.02 * sum(r["base_score"] for r in held) and all(r["score"] < 0 for r in found)
    assert LM.score_texts(none, training).count() == 0
    strange = LM.score_texts(odd, training).collect()
    assert len(strange) == len(ODD) and {r["n_tokens"] for r in strange if r["doc_id"] in (1, 2, 3)} == {1}


def test_every_place_trains_the_model(spark):
    """A word that stands at odd places only is learnt like one at even places."""
    codes = bytes([1, 2] * 400)
    texts = spark.createDataFrame([(bytearray(codes),)] * 40, "codes binary").coalesce(1)
    share = np.full(LM.OUTPUTS, 1 / LM.OUTPUTS)
    model = LM.LogBilinear.fresh(share)
    target, first = np.frombuffer(codes, np.uint8).astype(np.int64), np.array([0, len(codes)])
    before = model.log_probabilities(target, LM.contexts(target, first))
    for turn in range(2):
        model = LM.train_round(texts, model, share, turn)
    gain = model.log_probabilities(target, LM.contexts(target, first)) - before
    assert gain[4::2].mean() > 1 and gain[5::2].mean() > 1


# --- pipeline --------------------------------------------------------------------------


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_stage_takes_odd_rows(name, stage, spark, sf, odd, none):
    for docs in (odd, none):
        found = stage(spark, docs, sf)
        assert name == "source_mix" or found.columns == docs.columns
        found.collect()


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        kept[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert kept[name]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert not any(brute_contamination(t, items)[4] for t in list(texts.values())[:40])
    before = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if r["doc_id"] in kept["language_id"]]
    assert kept["near_duplicates"] == least_of_groups(before)
    result = P.run(spark, sf).select("doc_id").distinct().count()
    assert 0 < result <= len(texts)


def least_of_groups(docs, width=5, percent=80):
    """Ids of the documents that stay, all pairs compared."""
    sets = {}
    for key, text in docs:
        words = WORD.findall((text or "").translate(FOLD))
        sets[key] = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
    root = {k: k for k in sets}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {k for k in keys if top(k) == k}


def test_rules_that_lose_links_are_refused():
    for percent in (0, 50, 79, 101):
        with pytest.raises(ValueError):
            NG.Rule(percent=percent)


def test_stage_drops_near_copies_of_five_words(spark, sf):
    docs = near_copies(4)
    words = [f"w{k}" for k in range(60)]
    docs += [(9_000, " ".join(words)), (9_001, " ".join(words + [f"x{k}" for k in range(8)]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    kept = {r["doc_id"] for r in P.near_duplicates(spark, frame, sf).collect()}
    assert kept == least_of_groups(docs)
    assert 9_000 in kept and 9_001 not in kept
    assert least_of_groups(docs, 3, 90) - kept
