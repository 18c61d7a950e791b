"""Bounded, repeatable samples of labelled rows for fitting classifiers on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Classes are few; more than these are an error.
MAX_CLASSES = 1_000


def sample_by_class(rows: DataFrame, label: str, order: Column, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each class with the lowest hashes, twice that many in all classes at most.

    ``order`` is a hash of the row.  A count by class gives the part of the hash range
    to keep, so rows outside it are dropped by a filter of the scan and no class meets
    in one task.
    """
    counts = rows.groupBy(label).count().limit(MAX_CLASSES + 1).collect()
    if len(counts) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    part = F.shiftrightunsigned(order, 11) / float(1 << 53)
    kept = F.lit(False)
    for value, n in counts:
        kept = kept | (F.col(label).eqNullSafe(F.lit(value)) & (part < min(1.0, per_class / n)))
    return rows.filter(kept).orderBy(part).limit(2 * per_class * max(1, len(counts)))
