"""Running totals and joins per key that stay parallel when one key holds most rows.

A window over a key puts the whole key into one task.  Keys above ``hot_rows`` are
therefore cut into slots along the order column: each slot is an own window, and
the few slot totals carry the state from one slot to the next.  The outcome is
the same as that of the plain window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, VariantType

from pageloom.session import cut_lineage

HOT_ROWS = 2_000_000
SLOTS = 256
# Hot keys and their slot bounds of up to so many bytes are broadcast; more take a shuffled join.
BROADCAST_BYTES = 8 << 20


Exprs = Mapping[str, Column]


def _over(keys: Sequence[str], order: str, sums: Exprs, maxes: Exprs, current: bool) -> list[Column]:
    last = Window.currentRow if current else -1
    frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, last)
    return [F.sum(c).over(frame).alias(n) for n, c in sums.items()] + [
        F.max(c).over(frame).alias(n) for n, c in maxes.items()
    ]


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, order: str | None = None, slots: int = SLOTS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, so at most rows / ``hot_rows`` of them.

    With ``order`` also the bounds that cut the key into ``slots`` runs of like size.
    """
    cuts = [F.percentile_approx(order, [k / slots for k in range(1, slots)], 40 * slots).alias("_cuts")] if order else []
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n"), *cuts)
    return counted.filter(F.col("_n") > hot_rows).drop("_n")


def found_hot_keys(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, order: str | None = None, slots: int = SLOTS
) -> DataFrame | None:
    """The hot keys, counted ahead of the main work; None if there are none.

    The counting reads the keys only.  Knowing their size, the usual case without hot
    keys needs no second path, and a short list is broadcast, so that telling the keys
    apart does not itself gather the rows of a hot key.
    """
    hot = cut_lineage(hot_keys(df, keys, hot_rows, None))
    if hot.isEmpty():
        return None
    if order:
        # Only the rows of hot keys are looked at for their bounds.
        rows = df.select(*keys, order).join(hot.select(*[F.col(k).alias(f"_{k}") for k in keys]), _same(df, keys), "left_semi")
        hot = cut_lineage(hot_keys(rows, keys, hot_rows, order, slots))
    size = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) + 16 for k in keys), F.lit(8 * slots if order else 0))
    total = hot.select(F.sum(size)).first()[0]
    return F.broadcast(hot) if total <= BROADCAST_BYTES else hot


def _same(df: DataFrame, keys: Sequence[str]) -> Column:
    """Equal keys of ``df`` and of a table that has them behind an underscore; null equals null."""
    return reduce(and_, [df[k].eqNullSafe(F.col(f"_{k}")) for k in keys])


def _joined(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join by keys that may be null; the columns of ``df``, and those of ``other`` but the keys."""
    right = other.withColumnsRenamed({k: f"_{k}" for k in keys})
    return df.join(right, _same(df, keys), how).drop(*[f"_{k}" for k in keys])


def _in_slots(rows: DataFrame, keys: list[str], order: str, sums: Exprs, maxes: Exprs, current: bool) -> DataFrame:
    """One step of running values over rows that carry a ``_slot``."""
    local = rows.select("*", *_over([*keys, "_slot"], order, sums, maxes, current))
    totals = rows.groupBy(*keys, "_slot").agg(
        *[F.sum(c).alias(n) for n, c in sums.items()], *[F.max(c).alias(n) for n, c in maxes.items()]
    )
    before = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys,
        "_slot",
        *[F.sum(n).over(before).alias(f"_c_{n}") for n in sums],
        *[F.max(n).over(before).alias(f"_c_{n}") for n in maxes],
    )

    def combined(name: str) -> Column:
        here, carry = F.col(name), F.col(f"_c_{name}")
        if name in maxes:
            return F.greatest(here, carry).alias(name)
        return F.coalesce(here + carry, here, carry).alias(name)

    names = [*sums, *maxes]
    return _joined(local, carried, [*keys, "_slot"], "inner").select(*rows.columns, *[combined(n) for n in names])


def running_steps(
    df: DataFrame,
    keys: list[str],
    order: str,
    steps: Sequence[tuple[Exprs, Exprs]],
    include_current: bool = True,
    hot_rows: int = HOT_ROWS,
    slots: int = SLOTS,
) -> DataFrame:
    """Several steps of running sums and maxima; a step may use the values of those before.

    The keys are told apart once.  Cold keys take plain windows, which share one
    shuffle; hot keys take the slots of their own order range.
    """
    hot = found_hot_keys(df, keys, hot_rows, order, slots)
    cold = df if hot is None else _joined(df, hot, keys, "left_anti")
    for sums, maxes in steps:
        cold = cold.select("*", *_over(keys, order, sums, maxes, include_current))
    if hot is None:
        return cold
    # Rows without an order value come first, as in a plain window.
    slot = F.when(F.col(order).isNull(), 0).otherwise(1 + F.size(F.filter(F.coalesce("_cuts", F.array()), lambda c: c < F.col(order))))
    warm = _joined(df, hot, keys, "inner").withColumn("_slot", slot).drop("_cuts")
    for sums, maxes in steps:
        warm = _in_slots(warm, keys, order, sums, maxes, include_current)
    return cold.unionByName(warm.drop("_slot"))


def running(
    df: DataFrame,
    keys: list[str],
    order: str,
    sums: Exprs | None = None,
    maxes: Exprs | None = None,
    include_current: bool = True,
    **sizes: int,
) -> DataFrame:
    """Add running sums and maxima per key in the order of an integer column.

    ``order`` must be unique within a key.  ``include_current=False`` leaves the
    row itself out, which turns a maximum of ``struct(order, value)`` into a lag.
    """
    return running_steps(df, keys, order, [(sums or {}, maxes or {})], include_current, **sizes)


def number_rows(df: DataFrame, keys: list[str], order: str, name: str = "rn", **sizes: int) -> DataFrame:
    """Row number per key, starting at 1."""
    return running(df, keys, order, sums={name: F.lit(1).cast("long")}, **sizes)


def previous_value(
    df: DataFrame, keys: list[str], order: str, value: str, name: str, **sizes: int
) -> DataFrame:
    """Value of the previous row of the key, NULL for its first row."""
    pair = F.struct(F.col(order).alias("o"), F.col(value).alias("v"))
    marked = running(df, keys, order, maxes={"_prev": pair}, include_current=False, **sizes)
    return marked.select(*df.columns, F.col("_prev.v").alias(name))


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, VariantType)]


def total_order(df: DataFrame, column: str) -> Column:
    """The column, and a hash of the row's plain columns where it is equal: the same choice on every run."""
    return F.struct(F.col(column), F.xxhash64(*_hashable(df)))


def _spread(df: DataFrame, small: DataFrame, on: str, how: str, salts: int) -> DataFrame:
    """Join where the lookup side is repeated once per salt, so no key is tied to one task.

    The salt mixes plain columns with the number of the input split: copies of one row
    spread as well, and a task that runs again deals its rows out as before.
    """
    mixed = F.xxhash64(F.spark_partition_id(), *_hashable(df))
    salted = df.withColumn("_salt", F.pmod(mixed, F.lit(salts)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [on, "_salt"], how).drop("_salt")


def lookup(
    df: DataFrame, small: DataFrame, on: str, how: str = "left", hot_rows: int | None = None, salts: int = 64
) -> DataFrame:
    """Left or inner join to a table with one row per key, narrow or wide.

    It is planned without running anything, on batch and streaming frames: the join of
    adaptive execution splits partitions that hot keys make too large, as the right side
    has one row per key.  With ``hot_rows`` the keys above that number of rows are counted
    ahead (one job over the keys) and only their rows are repeated on the right; all other
    keys, and rows without a key, take the plain join.
    """
    if hot_rows is None or df.isStreaming:
        return df.join(small, on, how)
    hot = found_hot_keys(df.filter(F.col(on).isNotNull()), [on], hot_rows)
    if hot is None:
        return df.join(small, on, how)
    plain = df.join(hot, on, "left_anti").join(small, on, how)
    warm = _spread(df.join(hot, on, "left_semi"), small.join(hot, on, "left_semi"), on, how, salts)
    return plain.unionByName(warm)


def join_hot(left: DataFrame, right: DataFrame, on: str, hot_rows: int | None = None, salts: int = 64) -> DataFrame:
    """Left :func:`lookup`."""
    return lookup(left, right, on, "left", hot_rows, salts)


def nth_in_order(rows: DataFrame, marks: Sequence[str], n: int) -> Row | None:
    """The n-th row (from 1) by ``marks``, nulls first; None if there are fewer.

    Rows are dealt into ranges of the order, the ranges are counted, and only the one that
    holds the n-th row is looked into; the driver gets one number per range.
    """
    if n < 1:
        return None
    placed = rows.select(*marks).repartitionByRange(*marks).withColumn("_range", F.spark_partition_id())
    placed = cut_lineage(placed)
    before = 0
    for number, size in placed.groupBy("_range").count().orderBy("_range").collect():
        if before + size >= n:
            own = placed.filter(F.col("_range") == number).select(*marks)
            # Of a range only its first part is wanted, or its last part, whichever is shorter.
            ahead, behind = n - before, before + size - n + 1
            if ahead <= behind:
                return own.orderBy(*marks).limit(ahead).orderBy(*[F.desc_nulls_last(m) for m in marks]).first()
            return own.orderBy(*[F.desc_nulls_last(m) for m in marks]).limit(behind).orderBy(*marks).first()
        before += size
    return None
