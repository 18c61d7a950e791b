"""Spelling variants: words by hand, near words by brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pageloom.llm import spelling as SP
from pageloom.llm.queries import lost_letter

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_counts(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{doc_id}:{run}".encode()) if doc_id is not None else 1
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def brute_forms(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return out


def related_words(dice, n, letters, size):
    held = ["".join(dice.choices(letters, k=dice.randint(*size))) for _ in range(5)]
    while len(held) < n:
        w = dice.choice(held)
        for _ in range(dice.randint(1, 2)):
            k = dice.randrange(len(w) + 1)
            w = dice.choice([w[:k] + w[k + 1 :], w[:k] + dice.choice(letters) + w[k:], w[:k] + dice.choice(letters) + w[k + 1 :]])
        if len(w) >= size[0]:
            held.append(w)
    return sorted(set(held))


@pytest.mark.parametrize(("letters", "size"), [("ab", (7, 12)), ("abcdefgh", (7, 9)), ("abcxyzÀÿé×", (4, 9)), ("a", (4, 30))])
def test_near_words_equal_brute_force(spark, letters, size):
    dice = random.Random(len(letters))
    words = related_words(dice, 400, letters, size)
    table = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    found = [tuple(r) for r in SP.near_words(table).collect()]
    assert len(found) == len(set(found))
    assert set(found) == {(a, b) for a in words for b in words if a < b and one_edit(a, b)}


def test_pivots_share_no_character_and_cost_least():
    dice = random.Random(2)
    for _ in range(500):
        word = "".join(dice.choices("abcde", k=dice.randint(4, 12)))
        counts = np.array([dice.randrange(50) for _ in range(SP.COUNTERS)])
        places = SP.prefix_places(word, counts)
        cost = lambda k: counts[SP.gram_slot(word[k : k + 2])]  # noqa: E731, B023
        a, b = SP.pivot_places(word, places, counts)
        assert b - a >= 2 and {a, b} <= set(places)
        assert cost(a) + cost(b) == min(cost(x) + cost(y) for x in places for y in places if y - x >= 2)
        outside = [k for k in range(len(word) - 1) if k not in places]
        assert all(cost(k) >= cost(p) for k in outside for p in places)


def test_words_one_edit_apart_share_a_key():
    dice = random.Random(7)
    for _ in range(3_000):
        letters = dice.choice(["ab", "abcdef"])
        word = "".join(dice.choices(letters, k=dice.randint(4, 11)))
        k = dice.randrange(len(word) + 1)
        other = dice.choice([word[:k] + word[k + 1 :], word[:k] + dice.choice(letters) + word[k:], word[:k] + dice.choice(letters) + word[k + 1 :]])
        if one_edit(word, other) and len(other) >= 4:
            counts = np.array([dice.randrange(5) for _ in range(SP.COUNTERS)])
            one = set(SP.looked_up(word, counts)) & set(SP.found_by(other, counts))
            assert one or set(SP.looked_up(other, counts)) & set(SP.found_by(word, counts)), (word, other)


def test_forms_and_roots(spark):
    counts = {
        "aaaaaaa": 1_000, "aaaaaab": 100, "aaaaabb": 10, "aaaabbb": 1, "bbbbbbbb": 50, "bbbbbbb": 4, "cccccccc": 20, "ccccccd": 2,
        "ccccccc": 2, "dddddddd": 30, "ddddddde": 30, "ddddddd": 3, "alonealone": 7,
    }
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {tuple(r) for r in SP.spelling_forms(table).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert found == brute_forms(counts)
    assert ("aaaabbb", "aaaaabb", "aaaaaaa", 1, 1, 10) in found and ("ddddddd", "dddddddd", "dddddddd", 3, 2, 30) in found
    assert SP.spelling_forms(table.limit(0)).count() == 0


def test_words_of_odd_texts(spark):
    rows = [
        (1, None, "x"), (2, "", "x"), (3, "short Word words", "x"), (None, "Without_an-ID WITHOUT withoutanid", "x"),
        (4, "ÉCOLESÉCOLES écolesécoles Ñandúes ñandúes " * 3, "x"), (4, "ÉCOLESÉCOLES écolesécoles Ñandúes ñandúes " * 3, "x"),
        (5, "letters" * 20_000 + " letters123letters " + "numbers " * 70_000, "x"),
        *((k, "commonword commenword comonword another_commonword " * 3, "y") for k in range(10, 60)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _run string")
    found = {r["word"]: r["n"] for r in SP.word_counts(docs, alter=lost_letter).collect()}
    assert found == brute_counts([r[:2] for r in rows])
    assert SP.word_counts(docs.limit(0), alter=lost_letter).count() == 0
    table = SP.spelling_forms(SP.word_counts(docs, alter=lost_letter))
    assert {tuple(r) for r in table.select("word", "form", "root", "n", "n_near", "form_n").collect()} == brute_forms(found)
