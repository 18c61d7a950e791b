"""Merges and keyed snapshots on tables derived from the orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.operators import merge as M
from pageloom.operators import snapshot as S
from pageloom.plans.registry import query
from pageloom.sources.tables import table


def merge_target(spark: SparkSession, sf: str) -> DataFrame:
    """Orders known before: a twentieth is still missing."""
    return table(spark, sf, "orders").filter("o_orderkey % 20 <> 7").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderstatus").alias("status"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
        (F.col("o_orderkey") % 3 == 0).alias("is_old"),
        F.lit(False).alias("is_gone"),
    )


def merge_source(spark: SparkSession, sf: str) -> DataFrame:
    """Orders seen now: another twentieth is gone, every tenth has a new price."""
    changed = (F.col("o_orderkey") % 10 == 0).cast("long")
    return table(spark, sf, "orders").filter("o_orderkey % 20 <> 3").select(
        F.col("o_orderkey").alias("k"),
        (F.round(F.col("o_totalprice") * 100).cast("long") + changed).alias("cents"),
        F.lit("N").alias("status"),
        F.lit("seen").alias("note"),
    )


_SIDES = """
WITH t AS (SELECT o_orderkey AS k, o_orderstatus AS status, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
    o_orderkey % 3 = 0 AS is_old, false AS is_gone FROM orders WHERE o_orderkey % 20 <> 7),
s AS (SELECT o_orderkey AS k, CAST(round(o_totalprice * 100) AS BIGINT)
    + CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS cents, 'N' AS status
  FROM orders WHERE o_orderkey % 20 <> 3)
"""


def _merged(spark: SparkSession, sf: str, *clauses: M.Clause, **options: object) -> M.Merge:
    return M.merge(merge_target(spark, sf), merge_source(spark, sf), "k", clauses, **options)


@query(
    "m01_update_by_name",
    _SIDES
    + """
SELECT t.k, coalesce(s.status, t.status) AS status, coalesce(s.cents, t.cents) AS cents, is_old, is_gone
FROM t LEFT JOIN s ON t.k = s.k""",
)
def update_by_name(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, M.when_matched_update()).snapshot


@query(
    "m02_conditional_update",
    _SIDES
    + """
SELECT t.k, CASE WHEN s.k IS NOT NULL AND is_old THEN s.status ELSE t.status END AS status,
  CASE WHEN s.k IS NOT NULL AND is_old THEN s.cents ELSE t.cents END AS cents, is_old, is_gone
FROM t LEFT JOIN s ON t.k = s.k""",
)
def conditional_update(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, M.when_matched_update("t.is_old")).snapshot


@query(
    "m03_delete_matched",
    _SIDES + "SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.k = t.k)",
)
def delete_matched(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, M.when_matched_delete()).snapshot


@query(
    "m04_insert_by_name",
    _SIDES
    + """
SELECT * FROM t UNION ALL SELECT k, status, cents, NULL, false FROM s
WHERE NOT EXISTS (SELECT 1 FROM t WHERE s.k = t.k)""",
)
def insert_by_name(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, M.when_not_matched_insert(), defaults={"is_gone": "false"}).snapshot


@query(
    "m05_soft_delete",
    _SIDES
    + """
SELECT t.k, status, cents, is_old, (NOT is_old AND NOT EXISTS (SELECT 1 FROM s WHERE s.k = t.k)) AS is_gone
FROM t""",
)
def soft_delete(spark: SparkSession, sf: str) -> DataFrame:
    clause = M.when_not_matched_by_source_update({"is_gone": "true"}, "not t.is_old")
    return _merged(spark, sf, clause).snapshot


@query("m06_hard_delete", _SIDES + "SELECT t.* FROM t WHERE EXISTS (SELECT 1 FROM s WHERE s.k = t.k)")
def hard_delete(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, M.when_not_matched_by_source_delete()).snapshot


_UPSERT = (
    M.when_matched_update("s.cents <> t.cents"),
    M.when_not_matched_insert(),
    M.when_not_matched_by_source_update({"is_gone": "true"}),
)


@query(
    "m07_outcome_counts",
    _SIDES
    + """
SELECT (SELECT count(*) FROM s WHERE k NOT IN (SELECT k FROM t)) AS rows_inserted,
  (SELECT count(*) FROM s JOIN t ON s.k = t.k WHERE s.cents <> t.cents)
  + (SELECT count(*) FROM t WHERE k NOT IN (SELECT k FROM s)) AS rows_updated, CAST(0 AS BIGINT) AS rows_deleted""",
)
def outcome_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, *_UPSERT).counts


@query(
    "k08_merge_snapshot",
    _SIDES
    + """
SELECT coalesce(t.k, s.k) AS k, CASE WHEN t.k IS NULL OR s.cents <> t.cents THEN s.status ELSE t.status END
  AS status, coalesce(s.cents, t.cents) AS cents, is_old,
  CASE WHEN t.k IS NULL THEN NULL ELSE s.k IS NULL END AS is_gone
FROM t FULL JOIN s ON t.k = s.k""",
)
def merge_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, *_UPSERT).snapshot


@query(
    "m08_limited_merge",
    _SIDES
    + """
, c AS (SELECT s.k, s.cents, s.status, t.k AS old FROM s LEFT JOIN t ON s.k = t.k
  WHERE t.k IS NULL OR s.cents <> t.cents ORDER BY s.k LIMIT 40)
SELECT t.k, coalesce(c.status, t.status) AS status, coalesce(c.cents, t.cents) AS cents, is_old,
  NOT EXISTS (SELECT 1 FROM s WHERE s.k = t.k) AS is_gone FROM t LEFT JOIN c ON t.k = c.k
UNION ALL SELECT k, status, cents, NULL, NULL FROM c WHERE old IS NULL""",
)
def limited_merge(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf, *_UPSERT, order_by="k", limit=40).snapshot


@query(
    "m09_stale_seeds",
    _SIDES + "SELECT s.k, s.cents FROM s LEFT JOIN t ON s.k = t.k WHERE t.k IS NULL OR t.is_old",
)
def stale_seeds(spark: SparkSession, sf: str) -> DataFrame:
    source = merge_source(spark, sf).select("k", "cents")
    return M.without_fresh(source, merge_target(spark, sf), "k", "t.is_old")


@query(
    "m10_m11_composite_key",
    """
WITH l AS (SELECT o_custkey AS c, o_orderkey AS o, o_orderstatus AS st FROM orders),
t AS (SELECT * FROM l WHERE o % 9 <> 1), s AS (SELECT c, o, lower(st) AS st FROM l WHERE o % 9 <> 2)
SELECT coalesce(t.c, s.c) AS c, coalesce(t.o, s.o) AS o, s.st FROM t FULL JOIN s ON t.c = s.c AND t.o = s.o
WHERE s.o IS NOT NULL""",
)
def composite_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c"), F.col("o_orderkey").alias("o"), F.col("o_orderstatus").alias("st")
    )
    return M.merge(
        rows.filter("o % 9 <> 1"),
        rows.filter("o % 9 <> 2").withColumn("st", F.lower("st")),
        ["c", "o"],
        [M.when_matched_update(), M.when_not_matched_insert(), M.when_not_matched_by_source_delete()],
    ).snapshot


@query(
    "m12_clause_chain",
    _SIDES
    + """
SELECT coalesce(t.k, s.k) AS k,
  CASE WHEN t.k IS NULL THEN 'new' WHEN s.k IS NOT NULL AND s.cents <> t.cents THEN 'repriced' ELSE t.status END
    AS status,
  CASE WHEN t.k IS NULL THEN s.cents WHEN s.k IS NOT NULL AND s.cents <> t.cents THEN s.cents - t.cents
    ELSE t.cents END AS cents, is_old, is_gone
FROM t FULL JOIN s ON t.k = s.k
WHERE NOT (s.k IS NOT NULL AND t.k IS NOT NULL AND t.status = 'F' AND s.cents = t.cents)
  AND NOT (t.k IS NULL AND s.cents % 2 = 0)""",
)
def clause_chain(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(
        spark,
        sf,
        M.when_matched_update("s.cents <> t.cents", {"status": "'repriced'", "cents": "s.cents - t.cents"}),
        M.when_matched_delete("t.status = 'F'"),
        M.when_not_matched_insert("s.cents % 2 = 1", {"k": "s.k", "status": "'new'", "cents": "s.cents"}),
    ).snapshot


def cached_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders read as cache entries: one URL per order, cached at the order date."""
    return table(spark, sf, "orders").select(
        F.concat(F.lit("https://o.example/"), F.col("o_orderkey").cast("string")).alias("url"),
        F.col("o_custkey").alias("c"),
        F.col("o_orderstatus").alias("body"),
        F.col("o_orderdate").alias("cached_at"),
    )


def as_of() -> Column:
    return F.lit("1998-06-01 00:00:00").cast("timestamp_ntz")


@query(
    "k03_fresh_cache",
    """
SELECT 'https://o.example/' || o_orderkey AS url, o_orderstatus AS body FROM orders
WHERE o_orderdate > TIMESTAMP '1998-06-01 00:00:00' - INTERVAL 8760 HOUR""",
)
def fresh_cache(spark: SparkSession, sf: str) -> DataFrame:
    return S.fresh_entries(cached_orders(spark, sf), as_of(), 8760).select("url", "body")


@query(
    "k07_cache_misses",
    """
SELECT 'https://o.example/' || o_orderkey AS url FROM orders
WHERE o_orderdate <= TIMESTAMP '1998-06-01 00:00:00' - INTERVAL 8760 HOUR""",
)
def cache_misses(spark: SparkSession, sf: str) -> DataFrame:
    store = cached_orders(spark, sf)
    return S.cache_misses(store.select("url"), store, as_of(), 8760)


@query(
    "k04_k06_latest_entry",
    """
SELECT 'https://c.example/' || o_custkey AS url, max(o_orderkey) AS seq,
  nullif(arg_max(CASE WHEN o_orderstatus = 'P' THEN '-' ELSE o_orderstatus END, o_orderkey), '-') AS body_or_null
FROM orders GROUP BY 1""",
)
def latest_entry(spark: SparkSession, sf: str) -> DataFrame:
    entries = table(spark, sf, "orders").select(
        F.concat(F.lit("https://c.example/"), F.col("o_custkey").cast("string")).alias("url"),
        F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("body_or_null"),
    )
    stored = S.blank_to_null(entries, ["body_or_null"])
    return S.upsert_latest(stored.filter("seq % 2 = 0"), stored.filter("seq % 2 = 1"), ["url"], "seq")


@query(
    "k05_resume",
    """
SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderkey % 10 = 0)""",
)
def resume(spark: SparkSession, sf: str) -> DataFrame:
    seeds = table(spark, sf, "customer").select("c_custkey")
    state = table(spark, sf, "orders").filter("o_orderkey % 10 = 0").select(F.col("o_custkey").alias("c_custkey"))
    return S.unseen(seeds, state, "c_custkey")


@query(
    "k09_not_modified",
    """
SELECT p.page_id, CASE WHEN p.page_id % 2 = 0 THEN length(html) ELSE p.page_id END AS body_chars FROM pages p""",
)
def not_modified(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    even = F.col("page_id") % 2 == 0
    responses = pages.select(
        "page_id",
        F.when(even, 304).otherwise(200).alias("status"),
        F.when(~even, F.lpad(F.lit("x"), F.col("page_id").cast("int"), F.lit("x"))).alias("body"),
    )
    previous = pages.select("page_id", F.col("html").alias("body"))
    reused = S.reuse_unmodified(responses, previous, "page_id")
    return reused.select("page_id", F.length("body").cast("long").alias("body_chars"))


@query(
    "k01_k02_append_limited",
    """
SELECT o_orderkey AS k, o_orderstatus AS status FROM orders WHERE o_orderkey % 4 = 0
UNION ALL SELECT * FROM (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 4 = 1
  ORDER BY o_orderkey DESC LIMIT 25)""",
)
def append_limited(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    first = S.append_rows(None, orders.filter("o_orderkey % 4 = 0").toDF("k", "status"))
    more = orders.filter("o_orderkey % 4 = 1").orderBy(F.desc("o_orderkey"))
    return S.append_rows(first, more, limit=25)
