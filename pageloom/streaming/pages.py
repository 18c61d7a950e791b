"""Page rows as they finish: the batch form and its Structured Streaming twins."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from pageloom.functions import response as R
from pageloom.functions import script_vars as S
from pageloom.functions import tags as T
from pageloom.functions.htmlpath import json_object
from pageloom.operators import merge as M
from pageloom.operators import robots as RB
from pageloom.operators import schedule as SC
from pageloom.operators.snapshot import SnapshotTable, upsert_latest


def finished_pages(
    responses: DataFrame, robots: DataFrame | None = None, user_agent: str = "pageloom"
) -> DataFrame:
    """Flat page rows; URLs a robots file forbids are left out.

    Structured data is read from successful HTML pages only, and texts are empty
    rather than NULL.  Works on batch and streaming frames.
    """
    if robots is not None:
        responses = RB.allowed_urls(responses, robots, user_agent)
    readable = R.is_success("status") & R.is_html("content_type", "body")

    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    return responses.select(
        text("url").alias("url"),
        F.col("status").alias("status_code"),
        text("content_type").alias("content_type"),
        text("body").alias("body"),
        text("error").alias("error"),
        "response_time_ms",
        F.octet_length(text("body")).cast("long").alias("content_length"),
        F.when(readable, json_object(S.jsonld("body"))).otherwise("").alias("jsonld"),
        F.when(readable, F.to_json(T.open_graph("body"))).otherwise("").alias("opengraph"),
        F.lit("").alias("meta"),
    )


def stream_files(
    spark: SparkSession, folder: str, schema: StructType, files_per_batch: int | None = None, name: str | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream, optionally only those of one name pattern."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if name:
        reader = reader.option("pathGlobFilter", name)
    return reader.parquet(folder)


def append_available(stream: DataFrame, folder: str, checkpoint: str) -> None:
    """Append everything available to a parquet folder; a restart goes on where it stopped."""
    writer = stream.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint)
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()


def each_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand every available micro-batch to ``handle``."""
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def distinct_urls(stream: DataFrame, stamp: str, keep_for: str, url: str = "url") -> DataFrame:
    """First sighting of each URL; a URL is forgotten ``keep_for`` after it was seen."""
    return stream.withWatermark(stamp, keep_for).dropDuplicatesWithinWatermark([url])


def cache_updates(table: SnapshotTable, keys: Sequence[str], stamp: str) -> Callable[[DataFrame, int], None]:
    """Batch handler that upserts cache entries; repeating a batch changes nothing."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        version = batch_id + 1
        done = [v for v in table.versions() if v < version]
        old = table.read(done[-1]) if done else batch.limit(0)
        table.commit(upsert_latest(old, batch, keys, stamp), version)

    return handle


def merge_updates(
    table: SnapshotTable, on: str | Sequence[str], clauses: Sequence[M.Clause], order_by: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Batch handler that merges each micro-batch into the snapshot.

    The batch number is the version, so a repeated batch finds its version written.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        version = batch_id + 1
        done = [v for v in table.versions() if v < version]
        target = table.read(done[-1]) if done else batch.limit(0)
        table.commit(M.merge(target, batch, on, clauses, order_by).snapshot, version)

    return handle


_STATE = "samples long, ema double, delay double"
_DELAYS = "domain string, seq long, ms long, ema double, delay double"


def adaptive_delay_stream(
    attempts: DataFrame, start: float = 1.0, low: float = 0.5, high: float = 60.0
) -> DataFrame:
    """Adaptive delay of each domain; the state is three numbers per domain.

    The rows of a micro-batch are put in the order of ``seq``, however its files hold
    them; micro-batches count in the order of their arrival.  A domain's rows of one
    micro-batch meet in one task, so the trigger should bound the files it takes.
    """

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        samples, ema, delay = state.get if state.exists else (0, 0.0, start)
        # A group comes in pieces that are not ordered among themselves.
        rows = pd.concat(list(batches)).sort_values("seq")
        emas, delays = [], []
        for ms in rows["ms"]:
            samples += 1
            ema = float(ms) if samples == 1 else SC.EMA_WEIGHT * ms + (1 - SC.EMA_WEIGHT) * ema
            factor = SC.step_factor(ms, ema, samples)
            if factor > 1:
                delay = min(delay * factor, high)
            elif factor < 1:
                delay = max(delay * factor, low)
            emas.append(ema)
            delays.append(delay)
        state.update((samples, ema, delay))
        yield rows.assign(ema=emas, delay=delays)[["domain", "seq", "ms", "ema", "delay"]]

    return attempts.select("domain", "seq", "ms").groupBy("domain").applyInPandasWithState(
        update, _DELAYS, _STATE, "append", GroupStateTimeout.NoTimeout
    )
