"""Spelling variants of words: all pairs one edit apart, by pivotal bigrams.

Bigrams stand in one order for all words, rare ones first.  The *prefix* of a word holds its
first three bigrams in that order (and those equal to the third).  Among them two that share
no character always exist; the least frequent such pair, chosen by dynamic programming, are
the word's *pivots*.  One edit destroys one pivot at most.  Of two words one edit apart let a
be the one whose prefix ends earlier in the order: a surviving pivot of a stands in the prefix
of the other, so it is enough to look up the pivots of all words in the prefixes of all words.

If the edit lies behind the first pivot, all characters up to and with that pivot stay, and so
does its place from the front; else all characters from the second pivot on stay, and so does
its place from the back.  These are the position limits: a pivot meets a prefix bigram only
with the same characters on that side.  What remains on the other side differs by the one edit,
so one half of it agrees as well.  A key holds a bigram with its side and one half of the rest;
words that share a key are compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.text import lower_ascii
from pageloom.session import cut_lineage

#: Runs of letters.
LETTERS = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form is so many times as frequent as the word.
TIMES = 10
#: Bigrams destroyed by one edit, and one more.
PREFIX = 3
#: Counters of bigrams, whatever the alphabet; bigrams that share one are told apart by their letters.
COUNTERS = 1 << 16


def word_counts(
    docs: DataFrame,
    text: str = "text",
    alter: Callable[[Column], Column] | None = None,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """(word, n): the words of at least ``least_length`` characters that occur ``least_count`` times.

    A word is a longest run of letters, A-Z lower-cased.  ``alter`` may change it (what it
    makes longer has to have ``least_length`` characters before) and may read the other columns
    of ``docs``; a column ``_run`` is replaced.  Null and empty texts have no words; an empty
    table gives an empty result.  Counts are combined before the shuffle.
    """
    runs = F.regexp_extract_all(text, F.lit(f"{LETTERS}{{{least_length},}}"), F.lit(0))
    found = docs.withColumn("_run", F.explode(runs)).withColumn("_run", lower_ascii(F.col("_run")))
    word = alter(F.col("_run")) if alter else F.col("_run")
    found = found.select(word.alias("word")).filter(F.length("word") >= least_length)
    return found.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def gram_slot(gram: str) -> int:
    return (ord(gram[0]) * 0x9E3779B1 + ord(gram[1]) * 0x85EBCA77 >> 7) % COUNTERS


def gram_counts(words: DataFrame) -> np.ndarray:
    """How many words of the table hold a bigram of each counter; one row per counter reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for word in batch.column("word").to_pylist():
                for slot in {gram_slot(word[k : k + 2]) for k in range(len(word) - 1)}:
                    held[slot] += 1
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], ["slot", "n"])

    summed = words.select("word").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(COUNTERS, np.int64)
    out[summed.column("slot").to_numpy().astype(np.int64)] = summed.column("n").to_numpy()
    return out


def prefix_places(word: str, counts: np.ndarray) -> list[int]:
    """The places of the bigrams that come first in the order."""
    rank = [(int(counts[gram_slot(word[k : k + 2])]), word[k : k + 2]) for k in range(len(word) - 1)]
    bound = sorted(rank)[min(PREFIX, len(rank)) - 1]
    return [k for k, r in enumerate(rank) if r <= bound]


def pivot_places(word: str, places: list[int], counts: np.ndarray) -> tuple[int, int]:
    """Two places of the prefix whose bigrams share no character, of least frequency together.

    Going from left to right, ``one`` is the best bigram that ends before the present one
    begins, and ``two`` the best pair so far.
    """
    weight = {k: int(counts[gram_slot(word[k : k + 2])]) for k in places}
    two: tuple[int, int, int] | None = None
    one: tuple[int, int] | None = None
    waiting: list[int] = []
    for k in places:
        while waiting and waiting[0] <= k - 2:
            early = waiting.pop(0)
            one = min(one or (weight[early], early), (weight[early], early))
        if one:
            pair = (one[0] + weight[k], one[1], k)
            two = min(two or pair, pair)
        waiting.append(k)
    assert two is not None, "three bigrams hold two without a common character"
    return two[1], two[2]


def _halves(rest: str, size: int, front: bool) -> tuple[str, str]:
    """The two halves of a rest of ``size`` characters, as one of ``rest``'s length has them if they stay.

    ``front``: the halves next to the bigram and away from it are those at the beginning and
    the end, else the other way round.
    """
    near, far = size // 2, size - size // 2
    if front:
        return rest[:near], rest[len(rest) - far :] if far else ""
    return rest[len(rest) - near :] if near else "", rest[:far]


def _side_keys(word: str, at: int, side: int, sizes: Iterator[int] | range) -> Iterator[str]:
    """The keys of a bigram for one side: up to and with it (0) or from it on (1), and a half of the rest."""
    held, rest = (word[: at + 2], word[at + 2 :]) if side == 0 else (word[at:], word[:at])
    for size in sizes:
        if size >= 0:
            for half, part in enumerate(_halves(rest, size, side == 0)):
                yield f"{side}{half}{size} {held} {part}"


def found_by(word: str, counts: np.ndarray) -> list[str]:
    """The keys of a word's prefix, both sides of each bigram."""
    size = len(word) - 2
    return [
        key
        for at in prefix_places(word, counts)
        for side, rest in ((0, size - at), (1, at))
        for key in _side_keys(word, at, side, range(rest, rest + 1))
    ]


def looked_up(word: str, counts: np.ndarray) -> list[str]:
    """The keys of a word's pivots; the rest of the other word has one character less, as many, or one more."""
    first, second = pivot_places(word, prefix_places(word, counts), counts)
    rest = len(word) - 2 - first
    return [
        *_side_keys(word, first, 0, range(rest - 1, rest + 2)),
        *_side_keys(word, second, 1, range(second - 1, second + 2)),
    ]


def keys(words: DataFrame, counts: np.ndarray) -> DataFrame:
    """(word, key, pivot): what a word looks up (pivot) and what it is found by, as 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            every = batch.column("word").to_pylist()
            for pivot, listed in ((True, looked_up), (False, found_by)):
                own = [{digest(k) for k in listed(w, counts)} for w in every]
                size = [len(k) for k in own]
                held = np.fromiter((k for some in own for k in some), np.uint64, sum(size))
                word = batch.column("word").take(pa.array(np.repeat(np.arange(len(every)), size)))
                yield pa.RecordBatch.from_arrays(
                    [word, pa.array(held.view(np.int64)), pa.array(np.full(len(held), pivot))], ["word", "key", "pivot"]
                )

    return words.select("word").mapInArrow(run, "word string, key long, pivot boolean")


def near_words(words: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct words of the table that are one edit apart.

    An edit inserts, deletes or replaces one character.  Words have four characters or more.
    """
    counts = gram_counts(words)
    index = cut_lineage(keys(words, counts))
    pivots = index.filter("pivot").select("key", F.col("word").alias("p"))
    found = index.filter("not pivot").select("key", F.col("word").alias("q"))
    met = pivots.join(found, "key").filter(F.col("p") != F.col("q"))
    near = met.filter(F.levenshtein("p", "q", 1) == 1)
    return near.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def spelling_forms(words: DataFrame, times: int = TIMES) -> DataFrame:
    """``form``, ``root``, ``n_near`` and ``form_n`` of every row of ``words`` (word, n).

    ``n_near`` counts the words one edit apart.  ``form`` is the most frequent of them (of
    equals the least in order of characters) if it occurs at least ``times`` as often as the
    word, else null; ``form_n`` is its count.  ``root``: where following forms ends, the word
    itself without a form.  Words are distinct, not null and of four characters or more; an
    empty table gives an empty result.

    Work: one join of twelve keys a word with about as many.  A key fixes all characters on one
    side of a rare bigram and half of the others, so few words share one.  Counts grow at each
    step from form to form, so chains are short.
    """
    words = cut_lineage(words.select("word", "n"))
    near = cut_lineage(near_words(words))
    both = near.select(F.col("a").alias("word"), F.col("b").alias("other")).union(near.select("b", "a"))
    told = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("m")), "other")
    # The least of (-m, other): most frequent, then first in order of characters.
    best = told.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "other")).alias("top"))
    known = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("top.less") >= times * F.col("n"), F.struct(F.col("top.other").alias("form"), (-F.col("top.less")).alias("n"))).alias("chosen"),
    )
    known = cut_lineage(known)
    return known.join(_roots(known.filter("chosen is not null").select("word", F.col("chosen.form").alias("to"))), "word", "left").select(
        "word",
        F.col("chosen.form").alias("form"),
        F.coalesce("to", "word").alias("root"),
        "n",
        "n_near",
        F.col("chosen.n").cast("long").alias("form_n"),
    )


def _roots(links: DataFrame) -> DataFrame:
    """(word, to): the last word that the links lead to; each turn doubles the way."""
    links = cut_lineage(links)
    while True:
        onward = links.select(F.col("word").alias("to"), F.col("to").alias("next"))
        turned = cut_lineage(links.join(onward, "to", "left").select("word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")))
        links = turned.select("word", "to")
        if turned.filter("moved").isEmpty():
            return links
