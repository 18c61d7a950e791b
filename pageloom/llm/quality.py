"""Quality rules: boosted trees over statistics of whole documents, beside two fixed rules."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm import boosting
from pageloom.llm.sampling import sample_by_class
from pageloom.llm.text import mixed, pieces, span_hashes, window_hashes, words

STATISTICS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_lower",
    "n_digits",
    "n_marks",
    "n_ends",
)
#: Labelled documents of each class that the trees are fitted on.
SAMPLE_PER_CLASS = 4_000

_SYMBOLS = b"#*$%&|<>"
_NEWLINE = np.zeros(256, dtype=bool)
_NEWLINE[10] = True


def _set(members: bytes) -> np.ndarray:
    found = np.zeros(256, dtype=bool)
    found[list(members)] = True
    return found


_CLASSES = {
    "n_symbols": _set(_SYMBOLS),
    "n_upper": _set(bytes(range(65, 91))),
    "n_lower": _set(bytes(range(97, 123))),
    "n_digits": _set(bytes(range(48, 58))),
    "n_marks": _set(b"!?"),
    "n_ends": _set(b".,;:"),
    # Leading bytes of characters outside white space.
    "word_chars": _set(bytes(b for b in range(256) if not 0x80 <= b < 0xC0 and b not in b"\x20\t\n\x0b\x0c\r")),
}


def _sums(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int32)
    np.cumsum(mask, out=total[1:])
    return np.diff(total[offsets]).astype(np.int64)


def _again(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: whether its text has another equal one, and whether an earlier one."""
    with np.errstate(over="ignore"):
        key = mixed(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    any_equal, earlier = np.zeros(len(key), dtype=bool), np.zeros(len(key), dtype=bool)
    any_equal[order[1:][same]] = True
    any_equal[order[:-1][same]] = True
    earlier[order[1:][same]] = True
    return any_equal, earlier


def statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The statistics of each text of a piece."""
    found = words(data, offsets)
    out = {name: _sums(mask[data], offsets) for name, mask in _CLASSES.items()}
    out["n_words"] = found.counts
    lines = words(data, offsets, _NEWLINE)
    has_word = np.searchsorted(found.start, lines.start) < np.searchsorted(found.start, lines.end)
    hashes, owner = span_hashes(data, lines.start, lines.end)[has_word], lines.owner[has_word]
    n = len(offsets) - 1
    out["n_lines"] = np.bincount(owner, minlength=n)
    out["n_dup_lines"] = np.bincount(owner[_again(hashes, owner)[1]], minlength=n)
    runs, at = window_hashes(span_hashes(data, found.start, found.end), found.first, 5)
    twice = at[_again(runs, found.owner[at])[0]]
    places = len(found.start) + 1
    covered = np.cumsum(np.bincount(twice, minlength=places) - np.bincount(twice + 5, minlength=places))[:-1] > 0
    out["n_repeat_words"] = _sums(covered, found.first)
    return out


def document_statistics(
    docs: DataFrame, text: str = "text", keep_text: bool = False, trees: boosting.Trees | None = None
) -> DataFrame:
    """``STATISTICS`` as longs and ``bad_score`` beside the columns of ``docs``, without ``text`` unless asked for.

    ``bad_score`` is P(bad) by ``trees``, 0 without them.  Null and empty texts have zeros in
    all statistics.  One pass over whole texts, no shuffle; statistics and trees are one step.
    """
    docs = docs.drop(*STATISTICS, "bad_score")
    kept = [f for f in docs.schema.fields if keep_text or f.name != text]
    names = [*(f.name for f in kept), *STATISTICS, "bad_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in pieces(batch, text):
                found = statistics(data, offsets)
                bad = trees.probabilities(features(found)) if trees else np.zeros(rows.num_rows)
                arrays = [rows.column(f.name) for f in kept] + [pa.array(found[s], pa.int64()) for s in STATISTICS]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(bad, pa.float64())], names)

    shape = [T.StructField(s, T.LongType()) for s in STATISTICS] + [T.StructField("bad_score", T.DoubleType())]
    return docs.mapInArrow(run, T.StructType(kept + shape))


#: What the trees see, and how P(bad) may depend on it.
FEATURES = {
    "symbols_per_word": 1,
    "marks_per_word": 1,
    "repeated": 1,
    "doubled_lines": 1,
    "upper_share": 1,
    "digit_share": 1,
    "word_length": 0,
    "ends_per_word": 0,
    "words_per_line": 0,
    "log_words": 0,
}


def features(stats: dict[str, np.ndarray]) -> np.ndarray:
    s = {name: stats[name].astype(float) for name in STATISTICS}
    n_words, chars, lines = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1), np.maximum(s["n_lines"], 1)
    return np.stack(
        [
            s["n_symbols"] / n_words,
            s["n_marks"] / n_words,
            s["n_repeat_words"] / n_words,
            s["n_dup_lines"] / lines,
            s["n_upper"] / np.maximum(s["n_upper"] + s["n_lower"], 1),
            s["n_digits"] / chars,
            s["word_chars"] / n_words,
            s["n_ends"] / n_words,
            s["n_words"] / lines,
            np.log1p(s["n_words"]),
        ],
        axis=1,
    )


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality", per_class: int = SAMPLE_PER_CLASS
) -> boosting.Trees | None:
    """Trees for P(label = 0) from at most ``per_class`` labelled documents of each class (in the mean).

    None without labelled documents of both classes.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(id_column).isNotNull())
    known = known.select(F.col(id_column).alias("_id"), F.col(label).alias("_label"))
    chosen = sample_by_class(known, "_label", F.xxhash64(F.col("_id").cast("string")), per_class).distinct()
    rows = docs.join(F.broadcast(chosen), F.col(id_column) == F.col("_id")).select("_id", "_label", text)
    sample = document_statistics(rows, text).orderBy("_id", "_label", *STATISTICS).limit(4 * per_class).toArrow()
    columns = {c: sample.column(c).to_numpy() for c in ("_label", *STATISTICS)}
    if len(np.unique(columns["_label"])) < 2:
        return None
    return boosting.fit(features(columns), (columns["_label"] == 0).astype(float), np.array(list(FEATURES.values())))


def judge(
    docs: DataFrame, trees: boosting.Trees | None, text: str = "text", keep_text: bool = False, limit: float = 0.5
) -> DataFrame:
    """``STATISTICS``, ``base_failed``, ``bad_score`` and ``kept`` beside the columns of ``docs``.

    ``base_failed``: fewer than 10 words, or more than a fifth of the words in 5-word
    windows that occur again.  ``kept``: not so, and P(bad) below ``limit``.  Without
    labels of both classes only the fixed rules judge.  Columns named like the results are
    replaced.  No shuffle.
    """
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    stats = document_statistics(docs.drop("base_failed", "kept"), text, keep_text, trees)
    return stats.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("bad_score") < limit))
