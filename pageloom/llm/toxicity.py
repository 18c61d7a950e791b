"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels exist for documents only, so labelled tokens are made first: words and word
beginnings that stand almost only in toxic training documents mark the toxic tokens of
those documents.  The field is trained on them; a logistic regression turns the
marginals of a document into its score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm import crf
from pageloom.llm.sampling import sample_by_class
from pageloom.llm.text import FOLDED, Hasher, Words, held_out, mixed, pieces, text_bytes, window_hashes, words

#: Labelled documents of each class used for fitting, in the mean.
SAMPLE_PER_CLASS = 1_200

_BITS = 18
SLOTS = 1 << _BITS
#: Word beginnings in bytes; a shorter word has its whole for the longer ones.
_PREFIXES = (3, 4, 5, 6, 8)
_SUFFIX = 3
_APART = np.array([not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128) for c in range(256)])
#: A feature marks tokens if it stands in so many toxic documents and makes up this part of its documents.
_LEAST_DOCS, _PURITY = 4, 0.95


def token_slots(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """Runs of letters and digits and, for each, the slots of its word, beginnings and ending."""
    found = words(data, offsets, _APART)
    hasher = Hasher(data, FOLDED)
    spans = [(found.start, found.end)]
    spans += [(found.start, np.minimum(found.start + k, found.end)) for k in _PREFIXES]
    spans.append((np.maximum(found.end - _SUFFIX, found.start), found.end))
    out = np.empty((len(found.start), len(spans)), np.int64)
    for k, (a, b) in enumerate(spans):
        hashes = hasher.spans(a, b) ^ np.uint64((k + 1) * 0x632BE59BD9B4E019 & (1 << 64) - 1)
        out[:, k] = mixed(hashes) >> np.uint64(64 - _BITS)
    return found, out


def distinct_documents(slots: np.ndarray, found: Words, hashes: int = 4) -> np.ndarray:
    """Whether a document shares fewer than two of its four least shingle hashes with an earlier one.

    Copies would make the rare words of one toxic document look like toxic words.
    """
    runs, at = window_hashes(slots[:, 0].astype(np.uint64), found.first, 3)
    owner = np.searchsorted(found.first, at, side="right") - 1
    n = len(found.first) - 1
    least = np.full((hashes, n), np.iinfo(np.uint64).max, np.uint64)
    for k in range(hashes):
        np.minimum.at(least[k], owner, mixed(runs ^ np.uint64(k + 1)))
    seen: list[set] = [set() for _ in range(hashes)]
    kept = np.ones(n, dtype=bool)
    for doc in np.flatnonzero(np.bincount(owner, minlength=n)):
        own = [int(least[k, doc]) for k in range(hashes)]
        if sum(x in seen[k] for k, x in enumerate(own)) >= 2:
            kept[doc] = False
        else:
            for k, x in enumerate(own):
                seen[k].add(x)
    return kept


def marked_tokens(slots: np.ndarray, owner: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Token labels from document labels.

    Pure features are taken one after another, each time the one that explains most
    toxic documents without a mark so far; then further pure features of like support.
    """
    docs = len(toxic)
    weight = max(1.0, (toxic == 0).sum() / max(1, (toxic == 1).sum()))
    least = max(_LEAST_DOCS, (toxic == 1).sum() // 200)
    holders: dict[tuple[int, int], np.ndarray] = {}
    for k in range(slots.shape[1] - 1):
        pair = np.unique(slots[:, k] * docs + owner)
        slot, doc = pair // docs, pair % docs
        bad = np.bincount(slot[toxic[doc] == 1], minlength=SLOTS)
        good = np.bincount(slot[toxic[doc] == 0], minlength=SLOTS)
        pure = (bad >= least) & (bad * weight >= _PURITY * (bad * weight + good + 0.25))
        here = pure[slot] & (toxic[doc] == 1)
        edges = np.flatnonzero(np.diff(slot[here], prepend=-1))
        for one, group in zip(slot[here][edges], np.split(doc[here], edges[1:])):
            holders[(k, int(one))] = group
    unmarked = toxic == 1
    chosen: list[tuple[int, int]] = []
    while holders:
        gain = {f: int(unmarked[group].sum()) for f, group in holders.items()}
        best = max(gain, key=lambda f: (gain[f], -f[0], -f[1]))
        if gain[best] < least:
            break
        chosen.append(best)
        unmarked[holders[best]] = False
        taken = set(chosen)
        holders = {f: g for f, g in holders.items() if f in taken or gain[f] >= least or len(g) >= 3 * least}
    if chosen:
        like = 0.3 * float(np.median([len(holders[f]) for f in chosen]))
        chosen += [f for f, group in holders.items() if len(group) >= max(least, like)]
    marks = np.zeros(len(slots), dtype=bool)
    for k, slot in set(chosen):
        marks |= slots[:, k] == slot
    return marks & (toxic[owner] == 1)


@dataclass
class Tagger:
    weight: np.ndarray
    start: float
    moves: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    slope: np.ndarray
    shift: float

    def tag(self, data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
        """Tokens of a piece and P(toxic) of each."""
        found, slots = token_slots(data, offsets)
        odds = self.weight[slots].sum(axis=1)
        return found, crf.binary_marginals(odds, found.first, self.start, self.moves)[0]

    def scores(self, found: Words, p: np.ndarray) -> np.ndarray:
        z = (summary(found, p) - self.mean) / self.spread
        return 1.0 / (1.0 + np.exp(-np.clip(z @ self.slope + self.shift, -30, 30)))


def summary(found: Words, p: np.ndarray) -> np.ndarray:
    """For each document: expected toxic tokens, their density, the surest one, and its length."""
    n = len(found.first) - 1
    counts = found.counts
    total = np.bincount(found.owner, p, n)
    surest = np.zeros(n)
    full = counts > 0
    if len(p):
        surest[full] = np.maximum.reduceat(p, found.first[:-1][full])
    return np.stack([np.log1p(total), np.minimum(total, 3.0), np.log1p(1000 * total / (counts + 20)), surest, np.log1p(counts)], axis=1)


def fit_tagger(texts: pa.Array, toxic: np.ndarray) -> Tagger:
    """Token labels, the field, and the document regression."""
    data, offsets = text_bytes(texts)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    found, slots = token_slots(data, offsets)
    kept = distinct_documents(slots, found)
    slots = slots[kept[found.owner]]
    counts, toxic = found.counts[kept], toxic[kept]
    found = Words(found.start[:0], found.end[:0], np.concatenate([[0], np.cumsum(counts)]))
    labels = marked_tokens(slots, found.owner, toxic).astype(np.int64)
    weight, start, moves = crf.fit_binary(slots, SLOTS, labels, found.first)
    odds = weight[slots].sum(axis=1)
    p = crf.binary_marginals(odds, found.first, start, moves)[0]
    x = summary(found, p)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    slope, shift = _logistic((x - mean) / spread, toxic.astype(float))
    return Tagger(weight.astype(np.float32), start, moves, mean, spread, slope, shift)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Newton steps; both classes as frequent as in the sample."""
    design = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(design.shape[1])
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        g = design.T @ (q - y) / len(y) + ridge * beta
        h = (design.T * (q * (1 - q) + 1e-6)) @ design / len(y) + ridge * np.eye(len(beta))
        beta -= np.clip(np.linalg.solve(h, g), -3, 3)
    return beta[:-1], float(beta[-1])


def train(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic", per_class: int = SAMPLE_PER_CLASS
) -> Tagger | None:
    """Fit on about ``per_class`` labelled documents of each class outside the held-out fifth.

    None without labelled documents of both classes.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(id_column).isNotNull() & ~held_out(id_column))
    known = known.select(F.col(id_column).alias("_id"), F.col(label).alias("_label"))
    chosen = sample_by_class(known, "_label", F.xxhash64(F.lit(7), F.col("_id").cast("string")), per_class).distinct()
    rows = docs.join(F.broadcast(chosen), F.col(id_column) == F.col("_id")).select("_id", "_label", F.col(text).alias("_text"))
    sample = rows.orderBy("_id", "_label").limit(4 * per_class).toArrow().combine_chunks()
    if not sample.num_rows:
        return None
    toxic = np.array(sample.column("_label").to_pylist())
    if len(set(toxic.tolist())) < 2:
        return None
    column = sample.column("_text")
    return fit_tagger(column.chunk(0) if isinstance(column, pa.ChunkedArray) else column, toxic)


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])


def score(docs: DataFrame, tagger: Tagger | None, text: str = "text", spans: bool = True, limit: float = 0.5) -> DataFrame:
    """``score`` (0 to 1) and ``toxic_spans`` beside all columns of ``docs``.

    ``toxic_spans``: byte offsets of runs of tokens with P(toxic) of ``limit`` or more,
    each with its highest P.  A null or empty text, or one without letters and digits,
    has no tokens: no spans, and the score of a document without toxic tokens.  Without
    a tagger all scores are 0.  Columns of ``docs`` with the names of results are
    replaced.  One pass over whole texts, no shuffle.
    """
    docs = docs.drop("score", "toxic_spans")
    kept = docs.schema.fields
    shape = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("p", T.DoubleType())])
    extra = [T.StructField("score", T.DoubleType())] + [T.StructField("toxic_spans", T.ArrayType(shape))] * spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in pieces(batch, text):
                if tagger:
                    found, p = tagger.tag(data, offsets)
                    scores = tagger.scores(found, p)
                else:
                    found, scores = words(data, offsets, _APART), np.zeros(rows.num_rows)
                    p = np.zeros(len(found.start))
                arrays = [rows.column(f.name) for f in kept] + [pa.array(scores, pa.float64())]
                if spans:
                    arrays.append(_spans(found, p, offsets, limit))
                yield pa.RecordBatch.from_arrays(arrays, [*(f.name for f in kept), *(f.name for f in extra)])

    return docs.mapInArrow(run, T.StructType(kept + extra))


def _spans(found: Words, p: np.ndarray, offsets: np.ndarray, limit: float) -> pa.Array:
    hot = np.flatnonzero(p >= limit)
    owner = np.searchsorted(found.first, hot, side="right") - 1
    new = np.ones(len(hot), dtype=bool)
    new[1:] = (np.diff(hot) > 1) | (np.diff(owner) > 0)
    head = np.flatnonzero(new)
    tail = np.append(head, len(hot))[1:] - 1
    best = np.maximum.reduceat(p[hot], head) if len(head) else np.zeros(0)
    base = offsets[owner[head]]
    values = pa.StructArray.from_arrays(
        [pa.array(found.start[hot[head]] - base, pa.int64()), pa.array(found.end[hot[tail]] - base, pa.int64()), pa.array(best, pa.float64())],
        fields=list(_SPAN),
    )
    counts = np.bincount(owner[head], minlength=len(offsets) - 1)
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
