"""Keyed snapshots: response cache, resume state and versioned storage."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions.columns import ColumnOrName, col
from pageloom.operators.running import total_order


def fresh_entries(store: DataFrame, as_of: Column, ttl_hours: int = 24, stamp: str = "cached_at") -> DataFrame:
    """Entries younger than the time to live at ``as_of``."""
    return store.filter(F.col(stamp) > as_of - F.make_dt_interval(hours=F.lit(ttl_hours)))


def upsert_latest(old: DataFrame, new: DataFrame, keys: Sequence[str], stamp: str) -> DataFrame:
    """Old and new entries together, the latest per key wins; of equal stamps a hash of the entry decides.

    The winner of a key is found by stamp and hash alone.  Whole entries are moved once, to be
    looked up among the winners, and are not sorted; only copies of one entry are collapsed.
    """
    rows = old.unionByName(new, allowMissingColumns=True)
    columns = rows.columns
    placed = rows.withColumn("_place", total_order(rows, stamp))
    counted = placed.groupBy(*keys, "_place").agg(F.count("*").alias("_copies"))
    last = counted.groupBy(*keys).agg(F.max(F.struct("_place", "_copies")).alias("_last"))
    winners = last.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_last._place").alias("_won"), "_last._copies")

    def won(some: DataFrame) -> DataFrame:
        same = reduce(and_, [placed[k].eqNullSafe(F.col(f"_{k}")) for k in keys])
        met = same & placed["_place"].eqNullSafe(F.col("_won"))
        return placed.join(some.hint("shuffle_hash"), met, "left_semi").select(*columns)

    return won(winners.filter("_copies = 1")).unionByName(won(winners.filter("_copies > 1")).dropDuplicates([*keys]))


def blank_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Store empty texts as NULL, as cache entries do."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in columns})


def unseen(seeds: DataFrame, state: DataFrame, key: str = "url") -> DataFrame:
    """Seeds the state table has no entry for."""
    return seeds.join(state.select(key), key, "left_anti")


def cache_misses(seeds: DataFrame, store: DataFrame, as_of: Column, ttl_hours: int = 24) -> DataFrame:
    """Seeds without a fresh cache entry."""
    return unseen(seeds, fresh_entries(store, as_of, ttl_hours))


def reuse_unmodified(responses: DataFrame, previous: DataFrame, key: str = "url", body: str = "body") -> DataFrame:
    """Give a 304 response the body of the previous snapshot."""
    before = previous.select(key, F.col(body).alias("_old_body"))
    joined = responses.join(before, key, "left")
    kept = F.when(F.col("status") == 304, F.col("_old_body")).otherwise(F.col(body))
    return joined.withColumn(body, kept).drop("_old_body")


def append_rows(target: DataFrame | None, source: DataFrame, limit: int | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Source rows appended to a target by position, at most ``limit`` of them.

    A missing target takes the shape of the source.
    """
    if limit is not None:
        source = source.orderBy(*order).limit(limit) if order else source.limit(limit)
    if target is None:
        return source
    return target.union(source)


class SnapshotTable:
    """A folder of whole versions; a version counts once its write has committed."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        root = self._path(self.folder)
        if not self._fs.exists(root):
            return []
        found = []
        for entry in self._fs.listStatus(root):
            name = entry.getPath().getName()
            if name.startswith("v=") and self._fs.exists(self._path(f"{self.folder}/{name}/_SUCCESS")):
                found.append(int(name[2:]))
        return sorted(found)

    def read(self, version: int | None = None) -> DataFrame | None:
        found = self.versions()
        if not found:
            return None
        return self.spark.read.parquet(f"{self.folder}/v={found[-1] if version is None else version}")

    def commit(self, snapshot: DataFrame, version: int | None = None, if_not_empty: bool = False) -> int:
        """Write a version and return its number; an existing one is left as it is."""
        found = self.versions()
        number = version if version is not None else (found[-1] + 1 if found else 1)
        if number in found or (if_not_empty and not found and snapshot.isEmpty()):
            return number
        snapshot.write.mode("overwrite").parquet(f"{self.folder}/v={number}")
        return number


def not_older_than(stamp: ColumnOrName, as_of: Column, hours: int) -> Column:
    return col(stamp) >= as_of - F.make_dt_interval(hours=F.lit(hours))
