"""Streams run over everything available, beside their batch results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions import url as U
from pageloom.operators import merge as M
from pageloom.operators import snapshot as S
from pageloom.plans.registry import query
from pageloom.plans.response_queries import ADAPTIVE_DELAYS, rounded_delays
from pageloom.session import checkpoint_dir
from pageloom.sources.tables import response_store, table
from pageloom.streaming import pages as ST


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A raw table as a stream; it may be one file or a folder of files, which a pattern stands for alike."""
    return ST.stream_files(spark, f"{sf}/{{{name}.parquet}}", table(spark, sf, name).schema)


def _folders(spark: SparkSession) -> tuple[str, str]:
    root = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    return f"{root}/data", f"{root}/state"


@query(
    "st01_finished_pages",
    """
SELECT url, 200 AS status_code, 'text/html; charset=utf-8' AS content_type, '' AS error,
  CAST(0 AS BIGINT) AS response_time_ms, strlen(html) AS content_length, '{}' AS jsonld,
  '{}' AS opengraph, '' AS meta FROM pages""",
)
def finished_pages(spark: SparkSession, sf: str) -> DataFrame:
    data, state = _folders(spark)
    ST.append_available(ST.finished_pages(response_store(_stream(spark, sf, "pages"))), data, state)
    return spark.read.parquet(data).drop("body")


@query(
    "st01_finished_pages_with_robots",
    """
SELECT url, 200 AS status_code, strlen(html) AS content_length FROM pages
WHERE NOT (regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) LIKE 'blog.%' AND regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) SIMILAR TO '/[a-m].*')""",
)
def finished_pages_with_robots(spark: SparkSession, sf: str) -> DataFrame:
    """A stream of pages beside a table of robots files, planned without a job."""
    data, state = _folders(spark)
    hosts = table(spark, sf, "pages").select(U.host("url").alias("host")).distinct()
    rules = "".join(f"Disallow: /{letter}\n" for letter in "abcdefghijklm")
    files = hosts.select("host", F.when(F.col("host").startswith("blog."), f"User-agent: *\n{rules}").otherwise("User-agent: other\nDisallow: /\n").alias("body"))
    pages = ST.finished_pages(response_store(_stream(spark, sf, "pages")), files)
    ST.append_available(pages, data, state)
    return spark.read.parquet(data).select("url", "status_code", "content_length")


@query("st02_distinct_urls", "SELECT DISTINCT 'https://u' || user_id || '.example/' AS url FROM events")
def distinct_urls(spark: SparkSession, sf: str) -> DataFrame:
    data, state = _folders(spark)
    seen = _stream(spark, sf, "events").select(
        F.concat(F.lit("https://u"), F.col("user_id").cast("string"), F.lit(".example/")).alias("url"),
        F.col("ts").cast("timestamp").alias("ts"),
    )
    ST.append_available(ST.distinct_urls(seen, "ts", "3650 days"), data, state)
    return spark.read.parquet(data).select("url")


@query(
    "st03_cache_with_expiry",
    """
SELECT user_id, max(event_id) AS event_id FROM events GROUP BY 1
HAVING max(ts) > (SELECT max(ts) FROM events) - INTERVAL 12 HOUR""",
)
def cache_with_expiry(spark: SparkSession, sf: str) -> DataFrame:
    data, state = _folders(spark)
    cache = S.SnapshotTable(spark, data)
    entries = _stream(spark, sf, "events").select("user_id", "event_id", "ts")
    ST.each_batch(entries, ST.cache_updates(cache, ["user_id"], "event_id"), state)
    now = table(spark, sf, "events").agg(F.max("ts")).scalar()
    return S.fresh_entries(cache.read(), now, 12, "ts").select("user_id", "event_id")


@query(
    "st04_continuous_merge",
    "SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1",
)
def continuous_merge(spark: SparkSession, sf: str) -> DataFrame:
    data, state = _folders(spark)
    snapshot = S.SnapshotTable(spark, data)
    rows = _stream(spark, sf, "orders").select("o_custkey", "o_orderkey", F.col("o_orderstatus").alias("status"))
    clauses = [M.when_matched_update("s.o_orderkey > t.o_orderkey"), M.when_not_matched_insert()]
    ST.each_batch(rows, ST.merge_updates(snapshot, "o_custkey", clauses, order_by="o_orderkey"), state)
    return snapshot.read()


@query("st05_adaptive_delay", ADAPTIVE_DELAYS)
def adaptive_delay(spark: SparkSession, sf: str) -> DataFrame:
    data, state = _folders(spark)
    log = _stream(spark, sf, "events").select(
        F.concat(F.lit("host"), F.col("user_id").cast("string"), F.lit(".example")).alias("domain"),
        F.col("event_id").alias("seq"),
        F.round(F.col("value") * 100).cast("long").alias("ms"),
    )
    ST.append_available(ST.adaptive_delay_stream(log), data, state)
    return rounded_delays(spark.read.parquet(data))


