"""Whole texts as byte arrays: words, hashes and pieces of bounded size.

The operators of this folder read an Arrow batch as one block of bytes with
offsets and work on all of its texts at once.  A batch is cut into pieces of about
``PIECE_BYTES``; a longer text is a piece of its own and is never cut.  Null counts
as an empty text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE_BYTES = 1 << 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: A-Z to a-z for ``bytes.translate``.
FOLD_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: Words between white space.
SPACED_WORD = r"[^\x20\x09-\x0D]+"

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def blank_bytes(data: np.ndarray) -> np.ndarray:
    """Which bytes are white space."""
    return _BLANK[data]


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        z = values.astype(np.uint64, copy=True)
        z ^= z >> np.uint64(30)
        z *= np.uint64(0xBF58476D1CE4E5B9)
        z ^= z >> np.uint64(27)
        z *= np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return z


_CODE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: A code for each byte; the second one gives A-Z the codes of a-z.
EXACT = _CODE
FOLDED = _CODE.copy()
FOLDED[65:91] = _CODE[97:123]

_BASE = 0x5851F42D4C957F2D
_UNBASE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, PIECE_BYTES + 1)
        for k, base in enumerate((_BASE, _UNBASE)):
            _powers[k] = np.full(size, base, dtype=np.uint64)
            _powers[k][0] = 1
            _powers[k] = np.cumprod(_powers[k])
    return _powers[0], _powers[1]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its texts."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", dtype=np.uint8), offsets


def _trimmer() -> Callable[[int], int]:
    """The C library's own call to give unused memory back, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def give_back() -> None:
    """Returns memory that is free in this process to the machine; idle workers then hold little."""
    pa.default_memory_pool().release_unused()
    _trimmer()(0)


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with at most ``limit`` bytes of text, or one row; frees the memory of their use at the end."""
    data, offsets = text_bytes(batch.column(column))
    row = 0
    while row < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        last = min(max(last, row + 1), batch.num_rows)
        yield (
            batch.slice(row, last - row),
            data[offsets[row] : offsets[last]],
            offsets[row : last + 1] - offsets[row],
        )
        row = last
    del data, offsets
    give_back()


@dataclass
class Words:
    """Places of words in a piece; ``first`` has each text's first word and, last, their number."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = _BLANK) -> Words:
    """Runs of bytes outside ``blank``; a run ends with its text."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(offsets), np.int64))
    inside = ~blank[data]
    opening, closing = inside.copy(), inside.copy()
    opening[1:] &= ~inside[:-1]
    closing[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    opening[heads] = inside[heads]
    closing[tails] = inside[tails]
    start = np.flatnonzero(opening)
    return Words(start, np.flatnonzero(closing) + 1, np.searchsorted(start, offsets))


#: Spans from this length on are hashed by a digest: a polynomial modulo 2^64 gives some long texts of two letters one value.
_LONG = 512


class Hasher:
    """64-bit hashes of any spans of a piece, by differences of one running sum."""

    def __init__(self, data: np.ndarray, codes: np.ndarray = EXACT) -> None:
        self.data, self.codes = data, codes
        with np.errstate(over="ignore"):
            power, self.unpower = _tables(len(data) + 1)
            self.total = np.zeros(len(data) + 1, np.uint64)
            np.multiply(codes[data], power[: len(data)], out=self.total[1:])
            np.cumsum(self.total, out=self.total)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            found = self.total[end] - self.total[start]
            found *= self.unpower[start]
            found += (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        long = np.flatnonzero(end - start >= _LONG)
        if len(long):
            fold = FOLD_BYTES if self.codes is FOLDED else None
            spans = (self.data[a:z].tobytes().translate(fold) for a, z in zip(start[long], end[long]))
            found[long] = np.frombuffer(b"".join(blake2b(s, digest_size=8).digest() for s in spans), np.uint64)
        return mixed(found)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, codes: np.ndarray = EXACT) -> np.ndarray:
    """A hash of each span; equal bytes (after folding by ``codes``) have equal hashes."""
    return Hasher(data, codes).spans(start, end)


_STEP = np.uint64(0xD6E8FEB86659FD93)


def window_hashes(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``width`` words inside one text, and each run's first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        total = hashes[:n].copy()
        for k in range(1, width):
            total *= _STEP
            total += hashes[k : k + n]
    # A run that begins among the last width - 1 words of a text leaves it.
    whole = np.ones(n, dtype=bool)
    for k in range(1, width):
        ends = first[1:] - k
        whole[ends[(ends >= 0) & (ends < n) & (ends >= first[:-1])]] = False
    at = np.flatnonzero(whole)
    return mixed(total[at]), at


def lower_ascii(column: Column | str) -> Column:
    return F.translate(column, UPPER, LOWER)


def held_out(id_column: Column | str, parts: int = 5) -> Column:
    """Whether ``crc32`` of the id as text leaves no rest; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % parts == 0, F.lit(False))


def bounded_sample(rows: DataFrame, id_column: str, limit: int) -> DataFrame:
    """At most ``limit`` rows in the order of a hash of the id, the same ones on every run."""
    order = [F.xxhash64(F.col(id_column).cast("string")), F.col(id_column)]
    return rows.orderBy(*order).limit(limit)
