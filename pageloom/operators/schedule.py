"""Politeness, retry and adaptive delay rules as columns of a schedule table.

Everything that depends on the order within a domain goes through the slotted
running totals, so a domain holding a third of all URLs stays parallel.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions import response as R
from pageloom.operators.running import number_rows, running_steps
from pageloom.session import cut_lineage


def earliest_offsets(urls: DataFrame, delay_ms: Column, order: str = "seq", **sizes: int) -> DataFrame:
    """Earliest fetch of each URL: its place within the domain times the delay."""
    numbered = number_rows(urls, ["domain"], order, "_rn", **sizes)
    return numbered.withColumn("earliest_ms", (F.col("_rn") - 1) * delay_ms).drop("_rn")


def clamped_delay(robots_delay: Column, default: float, low: float, high: float) -> Column:
    return F.least(F.greatest(F.coalesce(robots_delay, F.lit(default)), F.lit(low)), F.lit(high))


def fetch_waves(urls: DataFrame, slots: int, order: str = "seq", **sizes: int) -> DataFrame:
    """Wave number per URL: one at a time with a robots delay, else ``slots`` together."""
    numbered = number_rows(urls, ["domain"], order, "_rn", **sizes)
    together = F.when(F.col("robots_delay").isNotNull(), 1).otherwise(slots)
    wave = F.floor((F.col("_rn") - 1) / together).cast("long")
    return numbered.withColumn("wave", wave).drop("_rn")


def backoff_seconds(failures: Column, maximum: int) -> Column:
    """Fibonacci backoff from 3 seconds: 3, 3, 6, 9, 15, ... up to ``maximum``."""
    steps, a, b = [3, 3], 3, 3
    while b < maximum:
        a, b = b, a + b
        steps.append(min(b, maximum))
    place = F.least(F.greatest(failures, F.lit(0)), F.lit(len(steps) - 1)).cast("int")
    return F.get(F.array(*[F.lit(s) for s in steps]), place)


def domain_blocks(attempts: DataFrame, max_backoff: int = 600, **sizes: int) -> DataFrame:
    """Failures in a row of the domain at each attempt and the block they cause.

    A 429, 500-504 or network failure extends the run, any other answer ends it;
    a Retry-After in seconds replaces the backoff.
    """
    failed = (F.col("status") == 429) | R.is_retryable("status")
    # A success resets the count: subtract the failures seen up to the last success.
    seen = {"_failures": F.col("_failed")}
    at_success = {"_base": F.when(F.col("_failed") == 0, F.col("_failures"))}
    based = running_steps(
        attempts.withColumn("_failed", failed.cast("long")),
        ["domain"],
        "seq",
        [(seen, {}), ({}, at_success)],
        **sizes,
    )
    in_row = F.col("_failures") - F.coalesce(F.col("_base"), F.lit(0))
    asked = F.floor(R.retry_after_ms("retry_after") / 1000)
    wait = F.when(asked > 0, asked).otherwise(backoff_seconds(in_row, max_backoff).cast("long"))
    return based.select(
        *attempts.columns,
        in_row.alias("failures_in_row"),
        F.when(F.col("_failed") == 1, wait).alias("blocked_seconds"),
    )


def retry_verdicts(attempts: DataFrame, max_retries: int = 5) -> DataFrame:
    """Retries spent per URL and whether it is given up."""
    failed = (F.col("status") == 429) | R.is_retryable("status")
    spent = F.count(F.when(failed, 1))
    return attempts.groupBy("url").agg(
        spent.alias("retries"), (spent > max_retries).alias("given_up")
    )


def domain_counters(attempts: DataFrame) -> DataFrame:
    """Crawled, failed and skipped URLs per domain."""
    status = F.col("status")
    return attempts.groupBy("domain").agg(
        F.count(F.when(R.is_success(status), 1)).alias("crawled"),
        F.count(F.when((status >= 400) | (status == 0), 1)).alias("failed"),
        F.count(F.when(status < 0, 1)).alias("skipped"),
    )


# Fixed values of the adaptive delay.
EMA_WEIGHT = 0.2
WARM_SAMPLES = 3
SLOWER, SLOWER_FACTOR = 2.0, 1.5
FASTER, FASTER_FACTOR = 0.5, 0.9

_CHUNK = 4096


def step_factor(ms: float, ema: float, samples: int) -> float:
    """Factor one response applies to the delay, 1 for none."""
    if samples >= WARM_SAMPLES and ms > SLOWER * ema:
        return SLOWER_FACTOR
    if samples >= WARM_SAMPLES and ms < FASTER * ema:
        return FASTER_FACTOR
    return 1.0


def adaptive_delays(
    attempts: DataFrame, start: float = 1.0, low: float = 0.5, high: float = 60.0, **sizes: int
) -> DataFrame:
    """Delay of the domain after each response.

    A domain is cut into chunks of 4096 responses.  The moving average a chunk starts
    from is a weighted sum over the whole chunk before it; what came earlier weighs
    0.8 ** 4096 and vanishes in a double.  A chunk acts on the delay as
    ``clamp(factor * d)``; those are chained per domain, one row per chunk, to give
    every chunk its start.
    """
    numbered = number_rows(attempts.select("domain", "seq", "ms"), ["domain"], "seq", "rn", **sizes)
    numbered = numbered.withColumn("chunk", F.floor((F.col("rn") - 1) / _CHUNK).cast("long"))
    behind = _CHUNK - 1 - (F.col("rn") - 1) % _CHUNK
    weight = F.pow(F.lit(1 - EMA_WEIGHT), behind) * F.when(F.col("rn") == 1, 1.0).otherwise(EMA_WEIGHT)
    carried = numbered.groupBy("domain", (F.col("chunk") + 1).alias("chunk")).agg(F.sum(weight * F.col("ms")).alias("carry"))
    started = numbered.join(carried, ["domain", "chunk"], "left")

    def averages() -> Fold:
        mean, weight = 0.0, 1.0

        def step(row: tuple, first: bool) -> tuple:
            nonlocal mean, weight
            domain, seq, ms, rn, chunk, carry = row
            value = math.nan if ms is None else float(ms)
            if first and chunk == 0:
                mean, weight = value, 1.0
            else:
                if first:
                    mean, weight = math.nan if carry is None else carry, 1.0
                if mean != mean:
                    mean = value
                else:
                    # A response without a time leaves the average, which then weighs less.
                    weight *= 1 - EMA_WEIGHT
                    if value == value:
                        if mean != value:
                            mean = (weight * mean + EMA_WEIGHT * value) / (weight + EMA_WEIGHT)
                        weight = 1.0
            return domain, seq, ms, rn, chunk, None if mean != mean else mean, step_factor(value, mean, rn)

        return step

    shape = "domain string, seq long, ms long, rn long, chunk long, ema double, factor double"
    # Read by three steps below, worked out once.
    factored = cut_lineage(_fold_in_order(started.select("domain", "seq", "ms", "rn", "chunk", "carry"), ["domain", "chunk"], "rn", averages, shape))

    def effects() -> Fold:
        scale, bottom, top = 1.0, 0.0, math.inf

        def step(row: tuple, first: bool) -> tuple:
            nonlocal scale, bottom, top
            if first:
                scale, bottom, top = 1.0, 0.0, math.inf
            domain, chunk, rn, factor = row
            scale *= factor
            bottom, top = clamp(bottom * factor, factor), clamp(top * factor, factor)
            return domain, chunk, rn, scale, bottom, top

        return step

    def clamp(delay: float, factor: float) -> float:
        if factor > 1:
            return min(delay, high)
        return max(delay, low) if factor < 1 else delay

    moved = factored.filter("factor <> 1").select("domain", "chunk", "rn", "factor")
    effect = "domain string, chunk long, rn long, scale double, bottom double, top double"
    summed = _fold_in_order(moved, ["domain", "chunk"], "rn", effects, effect)
    last = summed.groupBy("domain", "chunk").agg(F.max_by(F.struct("scale", "bottom", "top"), "rn").alias("_last"))
    summaries = last.select("domain", "chunk", "_last.*")

    def chain() -> Fold:
        delay = float(start)

        def step(row: tuple, first: bool) -> tuple:
            nonlocal delay
            domain, chunk, scale, bottom, top = row
            before = float(start) if first else delay
            delay = before if scale is None else min(max(before * scale, bottom), top)
            return domain, chunk, before

        return step

    # One narrow row per 4096 responses is left per domain.
    chunks = factored.select("domain", "chunk").distinct().join(summaries, ["domain", "chunk"], "left")
    starts = _fold_in_order(chunks, ["domain"], "chunk", chain, "domain string, chunk long, start_delay double")

    def delays() -> Fold:
        delay = float(start)

        def step(row: tuple, first: bool) -> tuple:
            nonlocal delay
            domain, chunk, rn, seq, ms, ema, factor, begin = row
            delay = clamp((begin if first else delay) * factor, factor)
            return domain, seq, ms, ema, delay

        return step

    joined = factored.join(starts, ["domain", "chunk"])
    joined = joined.select("domain", "chunk", "rn", "seq", "ms", "ema", "factor", "start_delay")
    return _fold_in_order(joined, ["domain", "chunk"], "rn", delays, "domain string, seq long, ms long, ema double, delay double")


_ARROW = {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}
#: Result row of a row, given whether it is the first one of its group.
Fold = Callable[[tuple, bool], tuple]


def _fold_in_order(rows: DataFrame, keys: list[str], order: str, make: Callable[[], Fold], shape: str) -> DataFrame:
    """A fold over each group in the order of a column, one result row per row.

    Groups lie one after another in a partition and are not gathered, so the work follows
    the rows, not the number of groups.
    """
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, order)
    names = rows.columns
    at = [names.index(k) for k in keys]
    fields = [part.split() for part in shape.split(", ")]
    target = pa.schema([(name, _ARROW[kind]) for name, kind in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, group = make(), None
        for batch in batches:
            found = []
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                own = tuple(row[i] for i in at)
                found.append(step(row, own != group))
                group = own
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), target)], schema=target)

    return dealt.mapInArrow(run, shape)


def folded_delays(values: Iterator[float], start: float, low: float, high: float) -> list[float]:
    """The same rule one response at a time; used by the stream and by tests."""
    ema, delay, out = 0.0, start, []
    for n, ms in enumerate(values, 1):
        ema = ms if n == 1 else EMA_WEIGHT * ms + (1 - EMA_WEIGHT) * ema
        factor = step_factor(ms, ema, n)
        delay = min(delay * factor, high) if factor > 1 else max(delay * factor, low) if factor < 1 else delay
        out.append(delay)
    return out
