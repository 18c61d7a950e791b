"""Readers for the raw tables and the response store built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Rows over all cores ahead of heavy work per row.

    Only an input with fewer splits than cores is dealt out; a large one keeps its
    splits and is not shuffled.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


#: Narrow rows of which a task makes pages.
ROWS_PER_TASK = 20_000


def dealt(rows: DataFrame) -> DataFrame:
    """Narrow rows in tasks of like size ahead of heavy work per row.

    A small file may hold very many of them, and its splits differ in their rows; they are
    counted (from the footers of the files) and dealt out, which moves little.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(cores, -(-rows.count() // ROWS_PER_TASK)))


def page_table(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "pages"))


def response_store(pages: DataFrame) -> DataFrame:
    """Captured pages in the shape of a response store (one row per URL)."""
    return pages.select(
        "url",
        F.lit(200).alias("status"),
        F.lit("text/html; charset=utf-8").alias("content_type"),
        F.col("html").alias("body"),
        F.lit(None).cast("string").alias("error"),
        F.lit(0).cast("long").alias("response_time_ms"),
    )
