"""Periodic runs of words in whole texts, found by string synchronising sets.

A run is a stretch of words with smallest period q, at least four periods long, that no
neighbouring word extends.  Periods below ``DIRECT`` are found by comparing each word with
the one q places on.  All longer periods are found at dyadic scales t: q in [t, 2t).

At scale t every window of t words gets a hash, and a position i is *selected* if the least
hash among the windows at i ... i + t is that of i or of i + t.  Windows with a period of at
most t/4 take no part; they lie in runs that the smaller scales have already found, and these
supply their periods.  Whether i is selected depends on the 2t words from i on alone, and each
t positions in a row hold a selected one unless 3t - 1 words have a period of at most t/4.  So
a run with smallest period q in [t, 2t) holds selected positions s and s + q with equal
contexts of 2t words, and none with that context between them: neighbours of equal context
propose all periods.  Proposals are compared word by word, so what is returned is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.text import Words, blank_bytes, mixed, pieces, words

LEAST_PERIODS = 4
LEAST_WORDS = 6
#: Periods below this are found by direct comparison; a power of two.
DIRECT = 4
#: Words compared at once.
_AT_ONCE = 1 << 20

_NONE = np.uint64((1 << 64) - 1)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def word_numbers(data: np.ndarray, found: Words) -> np.ndarray:
    """Equal words of a piece have equal numbers, different ones different numbers."""
    held = data[~blank_bytes(data)]
    ends = np.zeros(len(found.start) + 1, np.int64)
    np.cumsum(found.end - found.start, out=ends[1:])
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(found.start), [None, pa.py_buffer(ends), pa.py_buffer(held)])
    return column.dictionary_encode().indices.to_numpy()


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(left * _STEP + right)


def _hashes(numbers: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` words from each place on (a power of two)."""
    with np.errstate(over="ignore"):
        out = mixed((numbers.astype(np.uint64) + np.uint64(1)) * _GOLDEN)
    span = 1
    while span < width:
        out = _doubled(out, span)
        span *= 2
    return out


def _doubled(hashes: np.ndarray, span: int) -> np.ndarray:
    """Hashes of twice the width; those that reach over the end keep a value nobody reads."""
    out = hashes.copy()
    out[: len(out) - span] = _joined(hashes[: len(out) - span], hashes[span:])
    return out


def _islands(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last (excluded) place of each stretch of true flags."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _direct(numbers: np.ndarray, left: np.ndarray, least: int) -> list[np.ndarray]:
    """(start, length, period) of stretches with periods below ``DIRECT``."""
    out = []
    for q in range(1, min(DIRECT, len(numbers))):
        low, high = _islands((numbers[q:] == numbers[:-q]) & (left[:-q] > q))
        length = high - low + q
        kept = length >= least * q
        out.append(np.stack([low[kept], length[kept], np.full(kept.sum(), q)]))
    return out


def _selected(hashes: np.ndarray, periodic: np.ndarray, left: np.ndarray, scale: int) -> np.ndarray:
    """The synchronising positions of a scale."""
    low = np.where(periodic | (left < scale), _NONE, hashes >> np.uint64(1))
    least = low
    span = 1
    while span < scale:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:-1], least[1:])  # scale + 1 windows
    at = np.flatnonzero((left[: len(least)] >= 2 * scale) & (least != _NONE))
    return at[(least[at] == low[at]) | (least[at] == low[at + scale])]


def _proposals(at: np.ndarray, context: np.ndarray, text: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups of selected pairs with one distance: the distance, the first and the last place."""
    with np.errstate(over="ignore"):
        key = mixed(context[at] + text[at].astype(np.uint64) * _GOLDEN)
    order = np.argsort(key, kind="stable")  # places stay in order
    key, place = key[order], at[order]
    gap = place[1:] - place[:-1]
    near = (key[1:] == key[:-1]) & (gap >= scale) & (gap < 2 * scale)
    first, gap = place[:-1][near], gap[near]
    order = np.lexsort((first, gap))
    first, gap = first[order], gap[order]
    new = np.ones(len(first), dtype=bool)
    new[1:] = (gap[1:] != gap[:-1]) | (first[1:] > first[:-1] + 2 * scale)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(first))[: len(heads)] - 1
    return gap[heads], first[heads], first[tails]


def _extended(numbers: np.ndarray, low_end: np.ndarray, high_end: np.ndarray, gap: np.ndarray, first: np.ndarray, last: np.ndarray, scale: int) -> np.ndarray:
    """(start, length, period) of the stretch of each group.

    A run whose smallest period is ``gap`` ends within 3 * scale of its group: there would
    be another selected pair beyond.  What goes on has a smaller period and is left out.
    """
    low, high = np.maximum(low_end[first], first - 3 * scale), np.minimum(high_end[first] - gap, last + 5 * scale)
    out = []
    ends = np.cumsum(high - low)
    k = 0
    while k < len(gap):
        z = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + _AT_ONCE, side="right")))
        size = (high - low)[k:z]
        base = np.concatenate([[0], np.cumsum(size)])
        place = np.arange(base[-1]) + np.repeat(low[k:z] - base[:-1], size)
        broken = np.flatnonzero(numbers[place] != numbers[place + np.repeat(gap[k:z], size)])
        here = base[:-1] + first[k:z] - low[k:z]
        after = np.searchsorted(broken, here)
        padded = np.concatenate([[-1], broken, [base[-1]]])
        before, behind = padded[after], padded[after + 1]
        closed_left, closed_right = before >= base[:-1], behind < base[1:]
        start = np.where(closed_left, before + 1, base[:-1]) - base[:-1] + low[k:z]
        stop = np.where(closed_right, behind, base[1:]) - base[:-1] + low[k:z]
        whole = (closed_left | (low[k:z] == low_end[first[k:z]])) & (closed_right | (high[k:z] == high_end[first[k:z]] - gap[k:z]))
        found = np.stack([start, stop - start + gap[k:z], gap[k:z]])
        out.append(found[:, whole & (stop > start)])
        k = z
    return np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)


def find_runs(numbers: np.ndarray, first: np.ndarray, least_periods: int = LEAST_PERIODS, least_words: int = LEAST_WORDS) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, by text, start and period.

    ``numbers`` are the words of all texts, ``first`` each text's first word and, last, their
    number.  ``least_periods`` is 4 or more.
    """
    if least_periods < 4:
        raise ValueError("runs of fewer than four periods need another density of positions")
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    low_end, high_end = first[:-1][text], first[1:][text]
    left = high_end - np.arange(len(numbers))
    found = _direct(numbers, left, 4) or [np.zeros((3, 0), np.int64)]
    scale, at = DIRECT, np.arange(len(numbers))
    hashes = _hashes(numbers, scale) if len(numbers) else np.zeros(0, np.uint64)
    while True:
        # Only texts of four periods or more; the places of the others leave the arrays.
        long = (high_end - low_end)[at] >= 4 * scale
        if not long.any():
            break
        at, hashes = at[long], hashes[long]
        here_text, here_left = text[at], left[at]
        heads = np.flatnonzero(np.diff(here_text, prepend=-1))
        low = np.repeat(heads, np.diff(np.append(heads, len(at))))
        high = low + (high_end - low_end)[at]
        known = np.concatenate(found, axis=1)
        known = known[:, (4 * known[2] <= scale) & (known[1] >= scale)]
        marks = np.zeros(len(numbers) + 1, np.int32)
        np.add.at(marks, known[0], 1)
        np.add.at(marks, known[0] + known[1] - scale + 1, -1)
        periodic = (np.cumsum(marks)[:-1] > 0)[at]
        wide = _doubled(hashes, scale)
        chosen = _selected(hashes, periodic, here_left, scale)
        gap, a, z = _proposals(chosen, wide, here_text, scale)
        if len(gap):
            some = _extended(numbers[at], low, high, gap, a, z, scale)
            some = some[:, some[1] >= 4 * some[2]]
            found.append(np.stack([at[some[0]], some[1], some[2]]))
        hashes, scale = wide, 2 * scale
    start, length, period = np.concatenate(found, axis=1).astype(np.int64)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    # One stretch under several periods: the smallest one is its own.
    kept = np.ones(len(start), dtype=bool)
    kept[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    kept &= (length >= least_words) & (length >= least_periods * period)
    start, length, period = start[kept], length[kept], period[kept]
    owner = np.searchsorted(first, start, side="right") - 1
    out = np.stack([owner, start - first[owner], length, period], axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period; of equals the first, then that of least period."""
    best = None
    for run in runs:  # in order of start and period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


_RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_ARROW_RUN = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
_FIELDS = [T.StructField("runs", T.ArrayType(_RUN)), T.StructField("strongest", _RUN), T.StructField("collapsed", T.StringType())]


def _read(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, kept: list[str], least_periods: int, least_words: int) -> pa.RecordBatch:
    found = words(data, offsets)
    table = find_runs(word_numbers(data, found), found.first, least_periods, least_words)
    dropped = np.zeros(len(found.start) + 1, np.int32)
    head = found.first[table[:, 0]] + table[:, 1]
    np.add.at(dropped, head + table[:, 3], 1)
    np.add.at(dropped, head + table[:, 2], -1)
    stays = np.cumsum(dropped)[:-1] == 0
    raw = data.tobytes()
    cuts = np.searchsorted(table[:, 0], np.arange(rows.num_rows + 1))
    runs, best, texts = [], [], []
    for k in range(rows.num_rows):
        own = [tuple(r) for r in table[cuts[k] : cuts[k + 1], 1:].tolist()]
        parts = raw[offsets[k] : offsets[k + 1]].split()
        if own:
            parts = [p for p, ok in zip(parts, stays[found.first[k] : found.first[k + 1]].tolist()) if ok]
        runs.append([dict(zip(("start", "length", "period"), r)) for r in own])
        top = strongest(own)
        best.append(top and dict(zip(("start", "length", "period"), top)))
        texts.append(b" ".join(parts).decode())
    arrays = [rows.column(c) for c in kept]
    arrays += [pa.array(runs, pa.list_(_ARROW_RUN)), pa.array(best, _ARROW_RUN), pa.array(texts, pa.string())]
    return pa.RecordBatch.from_arrays(arrays, [*kept, *(f.name for f in _FIELDS)])


def periodic_runs(docs: DataFrame, text: str = "text", least_periods: int = LEAST_PERIODS, least_words: int = LEAST_WORDS) -> DataFrame:
    """Columns of ``docs`` but the text, and ``runs``, ``strongest`` and ``collapsed`` for every row.

    ``runs``: (``start``, ``length``, ``period``) in words, by start, then period; words lie
    between white space and are numbered from 0.  A stretch of at least ``least_words`` words
    and ``least_periods`` periods counts under its smallest period only.  ``strongest``: the
    run of greatest length / period, of equals the first, then that of least period; null
    without runs.  ``collapsed``: the words outside repeated periods, joined by one space;
    each run keeps its first period unless another run drops it.

    A null text and one without words have no runs and an empty ``collapsed``.  Words differ
    if a byte differs.  Repeated rows and null ids give a row each.  Columns of ``docs``
    named like the results are replaced; an empty table gives an empty result.

    Work: one pass over whole texts without a shuffle; the time grows with a text's words
    times the square of the logarithm of their number.
    """
    docs = docs.drop(*(f.name for f in _FIELDS))
    kept = [f for f in docs.schema.fields if f.name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in pieces(batch, text):
                yield _read(rows, data, offsets, [f.name for f in kept], least_periods, least_words)

    return docs.mapInArrow(run, T.StructType(kept + _FIELDS))


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per row the number of runs, the strongest one, and SHA-256 of all runs and of the collapsed text."""
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.col("strongest")
    return found.select(
        id_column,
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda s: F.concat(s, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
