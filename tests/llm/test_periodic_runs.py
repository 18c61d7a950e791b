"""Periodic runs: brute force over all periods, odd rows, long texts."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageloom.llm import periodic_runs as PR


def least_period(words):
    border = [0] * len(words)
    for i in range(1, len(words)):
        k = border[i - 1]
        while k and words[i] != words[k]:
            k = border[k - 1]
        border[i] = k + (words[i] == words[k])
    return len(words) - border[-1]


def brute(words):
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(6, 4 * q) and least_period(words[i : i + size]) == q:
                found.append((i, size, q))
            i = max(j, i) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def periodic_words(dice):
    out = []
    for _ in range(dice.randint(0, 6)):
        several, period = dice.choice([1, 2, 3, 9, 500]), dice.choice([1, 2, 3, 4, 5, 7, 8, 11, 16, 17, 30, 33])
        base = [dice.randrange(several) for _ in range(period)]
        if dice.random() < 0.3:  # a periodic inside of a period
            base = base * dice.randint(2, 6) + [dice.randrange(3)]
        size = dice.randint(1, 6 * len(base) + 1)
        out += (base * 8)[:size]
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    dice = random.Random(seed)
    for _ in range(60):
        texts = [periodic_words(dice) for _ in range(dice.randint(1, 4))]
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        numbers = np.array([w for t in texts for w in t], np.int32)
        wanted = [(k, *r) for k, t in enumerate(texts) for r in brute(t)]
        assert [tuple(r) for r in PR.find_runs(numbers, first).tolist()] == wanted


def test_runs_with_hashes_that_agree(monkeypatch):
    """Equal hashes of different windows cost nothing but work: positions stay consistent."""
    monkeypatch.setattr(PR, "_selected", lambda hashes, *rest, real=PR._selected: real(hashes & np.uint64(6), *rest))
    dice = random.Random(3)
    for _ in range(60):
        words = periodic_words(dice)
        found = PR.find_runs(np.array(words, np.int32), np.array([0, len(words)]))
        assert [tuple(r)[1:] for r in found.tolist()] == brute(words)


def test_fewer_than_four_periods_are_refused():
    with pytest.raises(ValueError):
        PR.find_runs(np.zeros(9, np.int32), np.array([0, 9]), least_periods=3)


def test_strongest_compares_exactly():
    assert PR.strongest([]) is None
    assert PR.strongest([(0, 9, 2), (5, 18, 4), (9, 14, 3)]) == (9, 14, 3)
    assert PR.strongest([(3, 8, 2), (3, 16, 4), (8, 4, 1)]) == (3, 8, 2)


def collapsed(words):
    gone = {i for s, n, q in brute(words) for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_rows(spark):
    dice = random.Random(5)
    base = [f"w{dice.randrange(400)}é" for _ in range(700)]
    texts = [
        None,
        "",
        " \n\t ",
        "one",
        "a a a a a a",
        "a a a a a",
        "A a A a A a A a x\ny  z x y z x y z x y z",
        "a b a b a b a b" * 2,
        " ".join(base * 5 + ["end"]),
        " ".join(base * 5 + ["end"]),
        "           ",
        " ".join(f"n{k}" for k in range(60_000)) + " tail" * 100_000,
    ]
    shape = "doc_id long, runs string, text string, collapsed int, strongest int"
    docs = spark.createDataFrame([(k if k != 3 else None, "x", t, 1, None) for k, t in enumerate(texts)], shape)
    found = PR.periodic_runs(docs).collect()
    assert len(found) == len(texts)
    by_id = {r["doc_id"]: r for r in found}
    for k, t in enumerate(texts[:-1]):
        words = (t or "").encode().split()
        words = [w.decode() for w in words]
        row = by_id[k if k != 3 else None]
        runs = [tuple(r) for r in row["runs"]]
        assert runs == brute(words)
        assert row["collapsed"] == collapsed(words)
        assert (row["strongest"] and tuple(row["strongest"])) == PR.strongest(runs)
    assert [tuple(r) for r in by_id[11]["runs"]] == [(60_000, 100_000, 1)]
    assert by_id[11]["collapsed"].endswith("n59999 tail")
    line = PR.digest(PR.periodic_runs(docs)).filter("doc_id = 4").first()
    assert tuple(line)[1:6] == (1, 0, 6, 1, 6000)
    assert line["runs_sha256"] == hashlib.sha256(b"0,6,1\n").hexdigest()
    assert PR.digest(PR.periodic_runs(docs)).filter("doc_id = 0 and n_runs = 0 and start is null and exponent_milli is null").count() == 1
    assert PR.periodic_runs(docs.limit(0)).count() == 0
    assert PR.periodic_runs(docs).filter(F.size("runs") > 0).columns.count("runs") == 1
