"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items.

Text and items are normalised alike: A-Z lower-cased, words between ASCII characters that are
no letter or digit.  Words become numbers, numbers a few digits, and the automaton reads the
digits of a text once.  Each place of a digit has signs of its own, so words cannot be met
out of step, and no node has many children.

A window is a run of ``width`` consecutive item words.  Items are cut into blocks of half that
length, one behind the other: every window holds a whole block.  The automaton holds the blocks
(and whole items shorter than a window), so it has a few nodes for each item word.  Where a
block is met, the words on both sides are compared with those of the item; a stretch of at
least ``width`` equal words is made of windows, and all of its words are hit.  The place of a
word in the original text follows from its number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.text import Words, pieces, words
from pageloom.session import cut_lineage

WINDOW = 10
#: Item words of an automaton; more items are scanned in several rounds.
AUTOMATON_WORDS = 2_000_000

_RUN_TYPE = T.StructType([T.StructField(n, T.LongType()) for n in ("first", "last", "start", "end")])
_FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(_RUN_TYPE)),
    T.StructField("items", T.ArrayType(T.StringType())),
]

_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_APART = np.frombuffer(_FOLD, np.uint8) == 32
_WORDS_AT_ONCE = 1 << 16


def item_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


@dataclass
class Slot:
    """Items as numbers of words; ``digest`` names the contents."""

    ids: list[str | None]
    lexicon: list[bytes]  # word number k + 1 is lexicon[k]; 0 stands for all other words
    numbers: np.ndarray
    first: np.ndarray  # of each item: its first word; last: the number of words
    digest: str

    @classmethod
    def of(cls, items: Sequence[tuple[object, str | None]]) -> Slot:
        known: dict[bytes, int] = {}
        numbers: list[int] = []
        first = [0]
        for _, text in items:
            numbers += [known.setdefault(w, len(known) + 1) for w in item_words(text)]
            first.append(len(numbers))
        ids = [None if item is None else str(item) for item, _ in items]
        named = hashlib.sha256(repr(ids).encode())
        for _, text in items:
            named.update(b"\x00" + b" ".join(item_words(text)))
        return cls(ids, list(known), np.array(numbers, np.int32), np.array(first, np.int64), named.hexdigest())


class Matcher:
    """The automaton of a slot and what is needed to compare the words around a block."""

    def __init__(self, slot: Slot, width: int) -> None:
        self.ids, self.width, self.block = slot.ids, width, (width + 1) // 2
        self.known = {w: k + 1 for k, w in enumerate(slot.lexicon)}
        self.numbers, self.first = slot.numbers, slot.first
        # Digits a word: so many that all signs of all places fit into one byte.
        self.digits = next(d for d in range(2, 9) if (256 // d) ** d > len(slot.lexicon))
        line, d = self._line(slot.numbers), self.digits
        held: dict[str, tuple[list[int], list[int]]] = {}
        for item, (low, high) in enumerate(zip(slot.first[:-1].tolist(), slot.first[1:].tolist())):
            if low < high < low + width:
                held.setdefault(line[d * low : d * high], ([], []))[1].append(item)
            elif low < high:
                for at in range(low, high - self.block + 1, self.block):
                    held.setdefault(line[d * at : d * (at + self.block)], ([], []))[0].append(at)
        self.automaton = ahocorasick.Automaton() if held else None
        while held:
            key, (places, whole) = held.popitem()
            self.automaton.add_word(key, (len(key) // d, tuple(places), tuple(whole)))
        if self.automaton:
            self.automaton.make_automaton()

    def _line(self, numbers: np.ndarray) -> str:
        """The digits of all numbers as characters below 256."""
        base, rest = 256 // self.digits, numbers.copy()
        out = np.empty((len(numbers), self.digits), np.uint8)
        for place in range(self.digits):
            out[:, place] = place * base + rest % base
            rest //= base
        return out.tobytes().decode("latin-1")

    def word_numbers(self, raw: bytes, places: Words, row: int) -> np.ndarray:
        """The numbers of the words of one text, some at a time."""
        low, high = int(places.first[row]), int(places.first[row + 1])
        out = np.empty(high - low, np.int32)
        for a in range(low, high, _WORDS_AT_ONCE):
            z = min(a + _WORDS_AT_ONCE, high)
            some = raw[places.start[a] : places.end[z - 1]].translate(_FOLD).split()
            out[a - low : z - low] = np.fromiter(map(self.known.get, some, repeat(0)), np.int32, z - a)
        return out

    def scan(self, numbers: np.ndarray) -> tuple[list[tuple[int, int]], set[int]]:
        """Runs of hit words [first, last) in order, merged, and the items that were met."""
        marks: list[tuple[int, int]] = []
        met: set[int] = set()
        if self.automaton is None or not numbers.any():
            return marks, met
        own: list[int] | None = None
        for sign, (size, places, whole) in self.automaton.iter(self._line(numbers)):
            own = numbers.tolist() if own is None else own
            end = sign // self.digits + 1
            if whole:
                marks.append((end - size, end))
                met.update(whole)
            for at in places:
                item = int(np.searchsorted(self.first, at, side="right")) - 1
                low, high = self._around(own, end - size, at, int(self.first[item]), int(self.first[item + 1]))
                if high - low >= self.width:
                    marks.append((low, high))
                    met.add(item)
        return merged(marks), met

    def _around(self, numbers: list[int], here: int, at: int, first: int, last: int) -> tuple[int, int]:
        """The stretch around a block that equals the item, as far as windows with the block reach."""
        reach, own = self.width - self.block, self.numbers
        low = 0
        while low < reach and at - low > first and here > low and own[at - low - 1] == numbers[here - low - 1]:
            low += 1
        high, here_end, at_end = 0, here + self.block, at + self.block
        while high < reach and at_end + high < last and here_end + high < len(numbers) and own[at_end + high] == numbers[here_end + high]:
            high += 1
        return here - low, here_end + high


def merged(runs: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    joined: list[list[int]] = []
    for a, b in sorted(runs):
        if joined and a <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], b)
        else:
            joined.append([a, b])
    return [(a, b) for a, b in joined]


#: The matcher that this worker used last, by the digest of its items.
_ready: dict[tuple[str, int], Matcher] = {}


def _matcher(sent: Broadcast, digest: str, width: int) -> Matcher:
    key = (digest, width)
    if key not in _ready:
        _ready.clear()
        _ready[key] = Matcher(sent.value, width)
    return _ready[key]


def item_slots(items: DataFrame, item_id: str, text: str, slot_words: int) -> Iterator[Slot]:
    """Items in slots of about ``slot_words`` words at most, in the order of their ids.

    The test items are read by the driver one partition at a time; it holds one slot.
    """
    held: list[tuple[object, str | None]] = []
    filled = 0
    for row in items.select(item_id, text).sort(item_id, text).toLocalIterator():
        n = len(item_words(row[1]))
        if held and filled + n > slot_words:
            yield Slot.of(held)
            held, filled = [], 0
        held.append((row[0], row[1]))
        filled += n
    yield Slot.of(held)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW,
    slot_words: int = AUTOMATON_WORDS,
) -> DataFrame:
    """All columns of ``docs`` and ``n_words``, ``hits``, ``items``.

    ``hits`` lists maximal runs of words that lie in an occurrence of a window:
    ``first`` and ``last`` word (last excluded) and ``start`` and ``end`` as byte
    offsets in the original UTF-8 text.  ``items`` lists, as strings in order and
    once each, the ids of items of which a window occurs; items without an id are
    listed as one null, after the others.

    A null or empty text has no words and no hits; null, empty or repeated items add
    nothing of their own (equal ids are listed once).  Without items every text is
    clean.  An empty table gives an empty result.  Columns of ``docs`` named like the
    results are replaced.  Whole texts are read, whatever their length.

    Work: one pass over the texts without a shuffle for every slot of items; a slot
    has a bounded number of words and is sent to each executor once.  A suite of tests
    fits in one; between further ones the table is kept in the shared folder, so that a
    task holds one automaton.
    """
    spark = docs.sparkSession

    def read(sent: Broadcast, digest: str, again: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(sent, digest, width)
            for batch in batches:
                for rows, data, offsets in pieces(batch, text):
                    yield _scanned(rows, data, offsets, matcher, again)

        return run

    found = docs.drop(*(f.name for f in _FIELDS))
    shape = T.StructType(found.schema.fields + _FIELDS)
    for number, slot in enumerate(item_slots(items, item_id, item_text, slot_words)):
        if number:
            found = cut_lineage(found)
        found = found.mapInArrow(read(spark.sparkContext.broadcast(slot), slot.digest, number > 0), shape)
    return found


_RUN = pa.struct([(n, pa.int64()) for n in ("first", "last", "start", "end")])


def _scanned(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, matcher: Matcher, again: bool) -> pa.RecordBatch:
    """One piece with its matches; ``again`` adds those of an earlier slot."""
    places = words(data, offsets, _APART)
    raw = data.tobytes()
    before_runs = rows.column("hits").to_pylist() if again else [[]] * rows.num_rows
    before_items = rows.column("items").to_pylist() if again else [[]] * rows.num_rows
    all_runs, all_items = [], []
    for k in range(rows.num_rows):
        first = int(places.first[k])
        runs, met = matcher.scan(matcher.word_numbers(raw, places, k))
        spans = merged([*((r["first"], r["last"]) for r in before_runs[k]), *runs]) if again else runs
        all_runs.append(
            [
                {"first": a, "last": b, "start": int(places.start[first + a] - offsets[k]), "end": int(places.end[first + b - 1] - offsets[k])}
                for a, b in spans
            ]
        )
        known = {*before_items[k], *(matcher.ids[m] for m in met)}
        all_items.append(sorted(known, key=lambda i: (i is None, i)) if len(known) > 1 else list(known))
    names = [n for n in rows.schema.names if n not in ("n_words", "hits", "items")]
    arrays = [rows.column(n) for n in names] + [
        pa.array(places.counts, pa.int64()),
        pa.array(all_runs, pa.list_(_RUN)),
        pa.array(all_items, pa.list_(pa.string())),
    ]
    return pa.RecordBatch.from_arrays(arrays, [*names, "n_words", "hits", "items"])


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per document the counts, and the SHA-256 of the met item ids joined by commas; a null id counts, but has no text."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["last"] - h["first"])
    return found.select(
        id_column,
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
