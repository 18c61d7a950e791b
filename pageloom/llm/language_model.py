"""Log-bilinear language model with noise-contrastive training, over exact corpus counts.

The model's outputs are the most frequent words, the end of a text, and classes of all
other words by their endings; inside a class a word has its smoothed share of the counts.
So every word, also an unseen one, has a probability, and those of all words add up to 1.

1. All words of the training documents are counted.
2. Every text becomes a string of output codes, one byte each.  Words outside a bounded
   table of frequent ones are looked up by a join.
3. Tasks train the model on the codes of their documents by noise-contrastive
   estimation; the parameters are averaged, and a second round starts from the average.
4. Batched matrix products give normalised log-probabilities of all tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.counting import value_counts
from pageloom.llm.text import FOLDED, Hasher, Words, pieces, words
from pageloom.session import cut_lineage

#: Words that are outputs of their own, beside the end of a text.
OUTPUT_WORDS = 191
CLASS_BITS = 6
CLASSES = 1 << CLASS_BITS
#: Words whose counts every task keeps at hand (12 bytes each).
TABLE_WORDS = 1 << 18
CONTEXT, WIDTH, NOISE = 4, 16, 32
#: A step takes places so far apart, so that it sees more texts; every round takes all places.
STRIDE = 4
SMOOTH = 0.1

END = OUTPUT_WORDS
OUTPUTS = OUTPUT_WORDS + 1 + CLASSES
_START = OUTPUTS  # stands before a text
_BATCH = 1_024
_TOKENS_AT_ONCE = 8_192


def word_values(data: np.ndarray, found: Words) -> np.ndarray:
    """A 64-bit value of each word, A-Z folded; its low bits are the class, a hash of the ending.

    The ending is the last three bytes before closing punctuation.
    """
    hasher = Hasher(data, FOLDED)
    end = found.end.copy()
    for _ in range(3):
        shorter = np.isin(data[end - 1], _PUNCTUATION) & (end - found.start > 1)
        end = np.where(shorter, end - 1, end)
    ending = hasher.spans(np.maximum(end - 3, found.start), end) >> np.uint64(64 - CLASS_BITS)
    return hasher.spans(found.start, found.end) & ~np.uint64(CLASSES - 1) | ending


_PUNCTUATION = np.frombuffer(b".,;:!?)\"'#$%&*|", np.uint8)


@dataclass
class Vocabulary:
    """Counts over the training texts: totals, the frequent words, and the weight of each class."""

    tokens: int  # all tokens, ends included
    words: int  # distinct tokens, the end included
    ends: int
    values: np.ndarray  # frequent words in order of value
    counts: np.ndarray
    codes: np.ndarray  # output of each: a word of its own or its class
    class_weight: np.ndarray
    output_share: np.ndarray

    def lookup(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code and count of each word; count -1 for a word outside the table."""
        codes = (OUTPUT_WORDS + 1 + (values & np.uint64(CLASSES - 1)).astype(np.int64)).astype(np.uint8 if OUTPUTS <= 256 else np.uint16)
        counts = np.full(len(values), -1, np.int64)
        if len(self.values):
            at = np.minimum(np.searchsorted(self.values, values), len(self.values) - 1)
            hit = self.values[at] == values
            counts[hit] = self.counts[at[hit]]
            codes[hit] = self.codes[at[hit]]
        return codes, counts


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """(value, n) of all words of ``docs``, kept in the shared folder."""

    def values(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, data, offsets in pieces(batch, text):
            found = words(data, offsets)
            if len(found.start):
                yield word_values(data, found)

    return cut_lineage(value_counts(docs.select(text), values, 1))


def vocabulary(counts: DataFrame, texts: int) -> Vocabulary:
    """The tables of the model from the word counts and the number of training texts."""
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # The count from which on words fit into the table, by a histogram of their logarithms.
    level = F.floor(F.log2("n") * 16).cast("int")
    sizes = sorted(((r[0], r[1]) for r in counts.groupBy(level.alias("level")).count().collect()), reverse=True)
    held, lowest = 0, 1 << 20
    for at, n in sizes:
        if held + n > TABLE_WORDS:
            break
        held, lowest = held + n, at
    table = counts.filter(level >= lowest).toArrow()
    values = table.column("value").to_numpy().astype(np.int64).view(np.uint64)
    n = table.column("n").to_numpy().astype(np.int64)
    order = np.argsort(values)
    values, n = values[order], n[order]
    codes = OUTPUT_WORDS + 1 + (values & np.uint64(CLASSES - 1)).astype(np.int64)
    best = np.lexsort((values, -n))[:OUTPUT_WORDS]
    codes[best] = np.arange(len(best))
    sums = counts.groupBy(F.col("value").bitwiseAND(CLASSES - 1).alias("class")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    weight = np.full(CLASSES, SMOOTH)
    share = np.zeros(OUTPUTS)
    for r in sums:
        weight[r["class"]] += r["n"] + SMOOTH * r["words"]
    own = values[best] & np.uint64(CLASSES - 1)
    np.subtract.at(weight, own.astype(np.int64), n[best] + SMOOTH)
    share[: len(best)] = n[best]
    share[END] = texts
    share[OUTPUT_WORDS + 1 :] = weight
    return Vocabulary(int(total) + texts, int(distinct) + (texts > 0), texts, values, n, codes.astype(np.uint8), np.maximum(weight, SMOOTH), (share + 1) / (share + 1).sum())


def encoded(docs: DataFrame, vocab: Vocabulary, text: str) -> DataFrame:
    """Columns of ``docs`` but the text, and ``n_tokens``, ``n_known``, ``log_counts``, ``class_log``, ``codes``, ``rare``.

    ``log_counts``: the sum of log10(c + 0.1) over the tokens of the table and the end;
    ``class_log``: the same over those that stand for their class, less the class weights of
    all such words; ``rare``: the words to be looked up.
    """
    kept = [f for f in docs.schema.fields if f.name != text]
    extra = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("log_counts", T.DoubleType()),
        T.StructField("class_log", T.DoubleType()),
        T.StructField("codes", T.BinaryType()),
        T.StructField("rare", T.ArrayType(T.LongType())),
    ]
    end_log = np.log10(vocab.ends + SMOOTH)
    class_log = np.log10(vocab.class_weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in pieces(batch, text):
                found = words(data, offsets)
                values = word_values(data, found)
                codes, counts = vocab.lookup(values)
                table, owner, n = counts >= 0, found.owner, rows.num_rows
                logs = np.where(table, np.log10(np.maximum(counts, 0) + SMOOTH), 0.0)
                by_class = codes > END
                inside = np.where(by_class, logs - class_log[np.maximum(codes.astype(np.int64) - END - 1, 0)], 0.0)
                out = np.insert(codes, found.first[1:], END)
                cuts = found.first + np.arange(n + 1)
                raw = out.tobytes()
                rare_first = np.concatenate([[0], np.cumsum(~table)])[found.first].astype(np.int32)
                arrays = [
                    pa.array(found.counts + 1, pa.int64()),
                    pa.array(np.bincount(owner, table, n).astype(np.int64) + (vocab.ends > 0), pa.int64()),
                    pa.array(np.bincount(owner, logs, n) + end_log, pa.float64()),
                    pa.array(np.bincount(owner, inside, n), pa.float64()),
                    pa.array([raw[a:z] for a, z in zip(cuts[:-1], cuts[1:])], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(rare_first), pa.array(values[~table].view(np.int64))),
                ]
                yield pa.RecordBatch.from_arrays([rows.column(f.name) for f in kept] + arrays, [*(f.name for f in kept), *(f.name for f in extra)])

    return docs.mapInArrow(run, T.StructType(kept + extra))


@dataclass
class LogBilinear:
    """Output scores are the product of a predicted vector and the output vectors, plus a bias.

    The prediction is the sum over the context of each place's matrix times the vector of
    the word that stands there.
    """

    words: np.ndarray  # (outputs + 1) x width
    places: np.ndarray  # context x width x width
    outputs: np.ndarray  # outputs x width
    bias: np.ndarray

    @classmethod
    def fresh(cls, share: np.ndarray, seed: int = 1) -> LogBilinear:
        dice = np.random.Generator(np.random.PCG64(seed))
        return cls(
            (dice.normal(size=(OUTPUTS + 1, WIDTH)) * 0.3).astype(np.float32),
            np.repeat(np.eye(WIDTH, dtype=np.float32)[None] / CONTEXT, CONTEXT, axis=0),
            (dice.normal(size=(OUTPUTS, WIDTH)) * 0.05).astype(np.float32),
            np.log(share).astype(np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.words, self.places, self.outputs, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    @classmethod
    def from_flat(cls, flat: np.ndarray) -> LogBilinear:
        shapes = [(OUTPUTS + 1, WIDTH), (CONTEXT, WIDTH, WIDTH), (OUTPUTS, WIDTH), (OUTPUTS,)]
        cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
        return cls(*[part.reshape(shape).astype(np.float32) for part, shape in zip(np.split(flat, cuts), shapes)])

    def log_probabilities(self, codes: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Natural logarithm of P(code | context) of each token, normalised over all outputs."""
        moved = np.einsum("ow,cwv->cov", self.words, self.places)
        out = np.empty(len(codes))
        for low in range(0, len(codes), _TOKENS_AT_ONCE):
            here, target = context[low : low + _TOKENS_AT_ONCE], codes[low : low + _TOKENS_AT_ONCE]
            q = moved[0][here[:, 0]]
            for k in range(1, CONTEXT):
                q += moved[k][here[:, k]]
            scores = q @ self.outputs.T
            scores += self.bias
            own = scores[np.arange(len(target)), target].astype(np.float64)
            top = scores.max(axis=1)
            scores -= top[:, None]
            np.exp(scores, out=scores)
            out[low : low + len(target)] = own - top - np.log(scores.sum(axis=1, dtype=np.float64))
        return out


def contexts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The codes before each token, nearest first; places before the text hold the start code."""
    out = np.full((len(codes), CONTEXT), _START, np.int64)
    at = np.arange(len(codes)) - np.repeat(first[:-1], np.diff(first))
    for k in range(CONTEXT):
        far = np.flatnonzero(at > k)
        out[far, k] = codes[far - k - 1]
    return out


class _Trainer:
    """AdaGrad on the noise-contrastive objective; a batch shares its noise, so all scores are matrix products."""

    def __init__(self, model: LogBilinear, share: np.ndarray, rate: float = 0.1, seed: int = 1) -> None:
        self.model, self.rate = model, rate
        self.log_noise = np.log(NOISE * share).astype(np.float32)
        self.cumulative = np.cumsum(share)
        self.dice = np.random.Generator(np.random.PCG64(seed))
        self.past = [np.full(p.shape, 1.0, np.float32) for p in model.parts()]

    def step(self, codes: np.ndarray, context: np.ndarray) -> None:
        """One update from a batch.

        What the context of each place contributes is a row of ``words`` times its matrix, so
        both gradients follow from the sums of the predictions' gradients by word and place.
        """
        m = self.model
        noise = np.minimum(np.searchsorted(self.cumulative, self.dice.random(NOISE)), OUTPUTS - 1)
        q = (m.words @ m.places[0])[context[:, 0]]
        for k in range(1, CONTEXT):
            q += (m.words @ m.places[k])[context[:, k]]
        real, unreal = m.outputs[codes], m.outputs[noise]
        true = np.einsum("nw,nw->n", q, real) + (m.bias - self.log_noise)[codes]
        false = q @ unreal.T
        false += (m.bias - self.log_noise)[noise]
        e_true, e_false = _logistic(true) - 1, _logistic(false)
        g_q = e_false @ unreal
        real *= e_true[:, None]
        g_q += real
        g_out = _sums_by(codes, q * e_true[:, None], OUTPUTS)
        g_bias = np.bincount(codes, e_true, OUTPUTS).astype(np.float32)
        np.add.at(g_out, noise, e_false.T @ q)
        np.add.at(g_bias, noise, e_false.sum(axis=0))
        g_words, g_places = np.zeros_like(m.words), np.empty_like(m.places)
        for k in range(CONTEXT):
            by_word = _sums_by(context[:, k], g_q, OUTPUTS + 1)
            g_places[k] = m.words.T @ by_word
            g_words += by_word @ m.places[k].T
        for part, past, g in zip(m.parts(), self.past, (g_words, g_places, g_out, g_bias)):
            past += g * g
            part -= self.rate * g / np.sqrt(past)


def _logistic(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)), in the memory of ``x``."""
    np.clip(x, -30, 30, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _sums_by(group: np.ndarray, rows: np.ndarray, groups: int) -> np.ndarray:
    """Sums of the rows of each group."""
    place = (group[:, None] * WIDTH + np.arange(WIDTH)).ravel()
    return np.bincount(place, rows.ravel(), groups * WIDTH).reshape(groups, WIDTH).astype(np.float32)


def _texts_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column("codes").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data.astype(np.int64), offsets - offsets[0]


def train_round(texts: DataFrame, model: LogBilinear, share: np.ndarray, turn: int, chunks: int = 32) -> LogBilinear:
    """Every task trains on its texts from ``model`` on; the mean of the results, weighted by tokens.

    Parameters travel in ``chunks`` parts, so that each is averaged by a task that keeps
    one sum, and the driver gets one row per part.
    """

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LogBilinear.from_flat(model.flat())
        trainer, seen = _Trainer(own, share, seed=turn + 1), 0
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                codes, first = _texts_of(batch.slice(low, 256))
                if not len(codes):
                    continue
                at = np.concatenate([np.arange(k, len(codes), STRIDE) for k in range(STRIDE)])
                before = contexts(codes, first)
                for k in range(0, len(at), _BATCH):
                    trainer.step(codes[at[k : k + _BATCH]], before[at[k : k + _BATCH]])
                seen += len(codes)
        if seen:
            parts = np.array_split(own.flat(), chunks)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(chunks)), pa.array([float(seen)] * chunks), pa.array([p.tobytes() for p in parts], pa.binary())],
                ["part", "seen", "held"],
            )

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[float, np.ndarray]] = {}
        for batch in batches:
            for part, seen, held in zip(*(batch.column(c).to_pylist() for c in ("part", "seen", "held"))):
                n, total = sums.get(part, (0.0, 0.0))
                sums[part] = (n + seen, total + seen * np.frombuffer(held, np.float32).astype(np.float64))
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int64()), pa.array([(total / n).astype(np.float32).tobytes() for n, total in sums.values()], pa.binary())],
                ["part", "held"],
            )

    fitted = texts.select("codes").mapInArrow(fit, "part long, seen double, held binary")
    rows = fitted.repartition(chunks, "part").mapInArrow(average, "part long, held binary").collect()
    if len(rows) < chunks:
        return model
    return LogBilinear.from_flat(np.concatenate([np.frombuffer(r["held"], np.float32) for r in sorted(rows, key=lambda r: r["part"])]))


def scored(texts: DataFrame, model: LogBilinear) -> DataFrame:
    """``log_model``: the sum of log10 P(code) over each text's codes."""
    kept = [f for f in texts.schema.fields if f.name not in ("codes", "log_model")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 128):
                rows = batch.slice(low, 128)
                codes, first = _texts_of(rows)
                logs = model.log_probabilities(codes, contexts(codes, first)) / np.log(10)
                owner = np.repeat(np.arange(rows.num_rows), np.diff(first))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(f.name) for f in kept] + [pa.array(np.bincount(owner, logs, rows.num_rows), pa.float64())],
                    [*(f.name for f in kept), "log_model"],
                )

    return texts.mapInArrow(run, T.StructType(kept + [T.StructField("log_model", T.DoubleType())]))


def score_texts(docs: DataFrame, training: Column, id_column: str = "doc_id", text: str = "text", rounds: int = 2) -> DataFrame:
    """Per row: id, ``training``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Tokens are the words between white space, A-Z lower-cased, and one end.  A null or
    empty text has the end alone.  ``base_score`` sums log10((c + 0.1) / (N + 0.1 (V + 1)))
    with the exact counts of the training texts (``training`` true), ``score`` is the
    model's log10 probability.  Equal texts get equal scores; null ids and repeated rows
    are rows of their own.  An empty table gives an empty result; without training texts
    all words are unknown and the model is the untrained one.

    Work: texts are read twice (counts, codes).  Counts are combined in each batch before
    the shuffle.  Words outside the table are joined with the counts by word; a hot word
    is always in the table.  Training covers all training texts where they lie.
    """
    source = docs.select(F.col(id_column).alias("id"), F.coalesce(training, F.lit(False)).alias("training"), F.col(text).alias("text"))
    learned = source.filter("training")
    counts = count_words(learned, "text")
    vocab = vocabulary(counts, learned.select("id").count())
    texts = cut_lineage(encoded(source, vocab, "text").withColumn("key", F.monotonically_increasing_id()))
    model = LogBilinear.fresh(vocab.output_share)
    for turn in range(rounds):
        model = train_round(texts.filter("training"), model, vocab.output_share, turn)
    narrow = texts.select("id", "training", "n_tokens", "n_known", "log_counts", "class_log", "codes", "key")
    done = scored(narrow, model)
    rare = texts.select("key", F.explode("rare").alias("value")).groupBy("key", "value").agg(F.count("*").alias("times"))
    met = rare.join(counts, "value", "left")
    logs = F.log10(F.coalesce("n", F.lit(0)) + SMOOTH)
    sums = met.groupBy("key").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("also_known"),
        F.sum(F.col("times") * logs).alias("rare_logs"),
    )
    norm = float(np.log10(vocab.tokens + SMOOTH * (vocab.words + 1)))
    rare_logs = F.coalesce("rare_logs", F.lit(0.0))
    return done.join(sums, "key", "left").select(
        F.col("id").alias(id_column),
        "training",
        "n_tokens",
        (F.col("n_known") + F.coalesce("also_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + rare_logs - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("log_model") + F.col("class_log") + rare_logs).alias("score"),
    )
