"""Language identification by error-correcting output codes.

Every language has a codeword of bits.  For each bit a binary n-gram classifier says on
which side of the code a text stands; the languages of a side share its n-gram counts.
A text gets the language whose codeword has the least loss, each bit weighted by how
well its classifier did, and is marked ambiguous where the runner-up is near.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.sampling import sample_by_class
from pageloom.llm.text import PIECE_BYTES, held_out, pieces, text_bytes

#: Training documents of each language, in the mean.
SAMPLE_PER_CLASS = 500
UNKNOWN = "und"

_SLOTS = 1 << 16
_ORDERS = (2, 4)
#: ASCII letters are folded, all other ASCII stands for a gap.
_FOLD = np.array(
    [c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], dtype=np.uint8
)
_ASCII_LETTER = np.array([97 <= _FOLD[c] <= 122 for c in range(256)])
_SMOOTH = 0.5
#: Segments of this many bytes stand beside whole documents when the bits are calibrated.
_SEGMENTS = (40, 200)


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """A row of +1/-1 for each of n classes: all two-sided splits up to 6 classes, else random ones far apart."""
    if n < 2:
        return np.zeros((n, 0))
    if n <= 6:
        splits = np.arange(1, 1 << (n - 1))
        bits = (splits[None, :] >> np.arange(n)[:, None]) & 1
        return np.where(bits == 1, 1.0, -1.0)
    dice = np.random.Generator(np.random.PCG64(seed))
    width, best, best_gap = int(np.ceil(10 * np.log2(n))), None, -1
    for _ in range(50):
        code = np.where(dice.random((n, width)) < 0.5, -1.0, 1.0)
        code[0, np.abs(code.sum(axis=0)) == n] *= -1
        gap = min(int((code[a] != code[b]).sum()) for a in range(n) for b in range(a))
        if gap > best_gap:
            best, best_gap = code, gap
    return best


def grams(data: np.ndarray, order: int) -> np.ndarray:
    """The slot of the n-gram at each byte; the last ones of the piece are filled up with gaps."""
    folded = np.full(len(data) + order, 32, np.uint32)
    folded[: len(data)] = _FOLD[data]
    if order == 2:
        return (folded[:-2] << 8 | folded[1:-1])[: len(data)]
    with np.errstate(over="ignore"):
        key = folded[: len(data)].copy()
        for k in range(1, order):
            key = key << 8 | folded[k : k + len(data)]
        key *= np.uint32(0x9E3779B1)
    return key >> 16


@dataclass
class Identifier:
    """Bit weights by n-gram slot, their calibration and the code."""

    languages: list[str]
    code: np.ndarray
    weights: list[np.ndarray]  # for each order: slots x bits
    scale: np.ndarray
    shift: np.ndarray
    trust: np.ndarray

    def evidence(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return _evidence(self.weights, data, offsets)

    def decode(self, evidence: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its score, and the score of the runner-up."""
        margin = evidence * self.scale + self.shift
        loss = np.logaddexp(0.0, -margin[:, None, :] * self.code[None]) @ self.trust
        near = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        near /= near.sum(axis=1, keepdims=True)
        order = np.argsort(-near, axis=1, kind="stable")
        rows = np.arange(len(near))
        second = near[rows, order[:, 1]] if near.shape[1] > 1 else np.zeros(len(near))
        return order[:, 0], near[rows, order[:, 0]], second


def _evidence(weights: list[np.ndarray], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean weight of a text's n-grams for each bit; n-grams across texts carry none."""
    bits = weights[0].shape[1]
    total = np.zeros((len(offsets) - 1, bits))
    sizes = np.diff(offsets)
    full = np.flatnonzero(sizes)
    if not len(full):
        return total
    for order, weight in zip(_ORDERS, weights):
        slots = grams(data, order)
        inside = np.ones(len(data), dtype=bool)
        for k in range(1, order):
            at = offsets[1:] - k
            inside[at[(at >= offsets[:-1])]] = False
        each = weight[slots]
        each[~inside] = 0
        total[full] += np.add.reduceat(each, offsets[:-1][full], axis=0)
    return total / (sizes + 20.0)[:, None]


def _in_pieces(weights: list[np.ndarray], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The evidence of many texts, about a megabyte at a time."""
    found, k = [], 0
    while k < len(offsets) - 1:
        last = max(k + 1, int(np.searchsorted(offsets, offsets[k] + PIECE_BYTES, side="right")) - 1)
        found.append(_evidence(weights, data[offsets[k] : offsets[last]], offsets[k : last + 1] - offsets[k]))
        k = last
    return np.concatenate(found) if found else np.zeros((0, weights[0].shape[1]))


def fit_identifier(texts: pa.Array, labels: list[str]) -> Identifier | None:
    """Bits from n-gram counts of each language, then a logistic calibration of each bit."""
    languages = sorted(set(labels))
    if not languages:
        return None
    code = codewords(len(languages))
    number = np.array([languages.index(x) for x in labels])
    order = np.argsort(number, kind="stable")
    number = number[order]
    data, offsets = text_bytes(texts.take(pa.array(order)))
    weights = []
    for n in _ORDERS:
        shares = np.zeros((len(languages), _SLOTS))
        for k in range(len(languages)):
            # Texts of a language stand side by side.
            low, high = offsets[np.searchsorted(number, k)], offsets[np.searchsorted(number, k, side="right")]
            for at in range(low, high, PIECE_BYTES):
                shares[k] += np.bincount(grams(data[at : min(high, at + PIECE_BYTES)], n), minlength=_SLOTS)
        # A run of gaps says nothing, and every language weighs the same, whatever the size of its sample.
        shares[:, grams(np.full(n, 32, np.uint8), n)[0]] = 0
        shares = (shares + _SMOOTH) / (shares.sum(axis=1, keepdims=True) + _SMOOTH * _SLOTS)
        bit = []
        for b in range(code.shape[1]):
            over, under = shares[code[:, b] > 0].mean(axis=0), shares[code[:, b] < 0].mean(axis=0)
            bit.append(np.clip(np.log(over / under), -4, 4))
        weights.append(np.stack(bit, axis=1).astype(np.float32) if bit else np.zeros((_SLOTS, 0), np.float32))
    if not code.shape[1]:
        return Identifier(languages, code, weights, np.zeros(0), np.zeros(0), np.zeros(0))
    seen, side = [_in_pieces(weights, data, offsets)], [number]
    for size in _SEGMENTS:
        # Short runs from everywhere in the sample, so that short texts are weighed rightly.
        start = np.arange(0, max(0, offsets[-1] - size), max(size, int(offsets[-1]) // 4_000), dtype=np.int64)
        runs = np.concatenate([data[a : a + size] for a in start]) if len(start) else data[:0]
        seen.append(_in_pieces(weights, runs, np.arange(len(start) + 1, dtype=np.int64) * size))
        side.append(number[np.searchsorted(offsets, start, side="right") - 1])
    x, at = np.concatenate(seen), np.concatenate(side)
    scale, shift, trust = np.zeros(code.shape[1]), np.zeros(code.shape[1]), np.zeros(code.shape[1])
    for b in range(code.shape[1]):
        y = (code[at, b] > 0).astype(float)
        scale[b], shift[b], loss = _calibrated(x[:, b].astype(float), y)
        trust[b] = 1.0 / (0.05 + loss)
    return Identifier(languages, code, weights, scale, shift, trust / trust.mean())


def _calibrated(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression of one input by Newton steps: slope, offset and mean loss."""
    a, c = 1.0, 0.0
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a * x + c, -40, 40)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - y) * x).mean() + 1e-5 * a, (p - y).mean()])
        h = np.array([[(w * x * x).mean() + 1e-5, (w * x).mean()], [(w * x).mean(), w.mean() + 1e-9]])
        step = np.linalg.solve(h, g)
        a, c = a - float(np.clip(step[0], -5, 5)), c - float(np.clip(step[1], -5, 5))
    z = a * x + c
    return a, c, float(np.logaddexp(0, np.where(y > 0, -z, z)).mean())


def train(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang", per_class: int = SAMPLE_PER_CLASS) -> Identifier | None:
    """Fit on about ``per_class`` documents of each non-null language outside the held-out fifth."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(id_column).isNotNull())
    rows = rows.filter(~held_out(id_column)).select(id_column, lang, text)
    order = F.xxhash64(F.lit(3), F.col(id_column).cast("string"))
    sample = sample_by_class(rows, lang, order, per_class).toArrow().combine_chunks()
    if not sample.num_rows:
        return None
    column = sample.column(text)
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return fit_identifier(column, sample.column(lang).to_pylist())


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def identify(docs: DataFrame, model: Identifier | None, text: str = "text", near: float = 0.25) -> DataFrame:
    """``lang_pred``, ``score`` and ``ambiguous`` beside all columns of ``docs``.

    A null text, an empty one and one without any letter get ``und`` and score 0; so
    does everything if there was nothing to learn from.  ``ambiguous``: the runner-up
    has a score of ``near`` or more.  Equal texts get equal results; of languages with
    equal loss the first in code point order is taken.  Columns of ``docs`` with the
    names of results are replaced.  One pass over whole texts, no shuffle.
    """
    docs = docs.drop("lang_pred", "score", "ambiguous")
    kept = docs.schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in pieces(batch, text):
                letters = np.zeros(len(data) + 1, np.int32)
                np.cumsum(_ASCII_LETTER[data], out=letters[1:])
                some = np.diff(letters[offsets]) > 0
                for k in np.flatnonzero(~some & (np.diff(offsets) > 0)):
                    some[k] = has_letter(data[offsets[k] : offsets[k + 1]].tobytes())
                if model:
                    best, score, second = model.decode(model.evidence(data, offsets))
                    names = np.array(model.languages, dtype=object)[best]
                else:
                    score = second = np.zeros(rows.num_rows)
                    names, some = np.full(rows.num_rows, UNKNOWN, dtype=object), some & False
                yield pa.RecordBatch.from_arrays(
                    [rows.column(f.name) for f in kept]
                    + [
                        pa.array(np.where(some, names, UNKNOWN), pa.string()),
                        pa.array(np.where(some, score, 0.0), pa.float64()),
                        pa.array(some & (second >= near), pa.bool_()),
                    ],
                    [*(f.name for f in kept), "lang_pred", "score", "ambiguous"],
                )

    out = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]
    return docs.mapInArrow(run, T.StructType(kept + out))
