"""The relational forms the sample analyses use, one named query each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions import tags as T
from pageloom.functions import url as U
from pageloom.operators.running import lookup
from pageloom.plans.registry import query
from pageloom.sources.tables import page_table, table


@query(
    "rel_latest_row_per_url",
    """
SELECT o_custkey, o_orderkey, o_orderstatus FROM orders o
WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders i WHERE i.o_custkey = o.o_custkey)""",
)
def latest_row(spark: SparkSession, sf: str) -> DataFrame:
    """A correlated maximum, written as one partial aggregate."""
    orders = table(spark, sf, "orders")
    return orders.groupBy("o_custkey").agg(
        F.max("o_orderkey").alias("o_orderkey"), F.max_by("o_orderstatus", "o_orderkey").alias("o_orderstatus")
    )


@query(
    "rel_inner_join",
    """
SELECT n_name, count(*) AS orders, sum(CAST(round(o_totalprice * 100) AS BIGINT))::BIGINT AS cents
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def inner_join(spark: SparkSession, sf: str) -> DataFrame:
    """Pre-aggregated per customer ahead of the join, so a busy customer is one row."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    spent = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("orders"), F.sum(cents).alias("cents")
    )
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    per_nation = spent.join(customers, "c_custkey").groupBy("n_nationkey").agg(
        F.sum("orders").alias("orders"), F.sum("cents").alias("cents")
    )
    return per_nation.join(nations, "n_nationkey").select("n_name", "orders", "cents")


@query(
    "rel_lateral_join",
    """
WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1)) AS href FROM pages)
SELECT page_id, count(*) AS links, count(DISTINCT href) AS targets FROM a GROUP BY 1""",
)
def lateral_join(spark: SparkSession, sf: str) -> DataFrame:
    found = T.links(page_table(spark, sf), ["page_id"])
    per_target = found.groupBy("page_id", "link").agg(F.count("*").alias("n"))
    return per_target.groupBy("page_id").agg(F.sum("n").alias("links"), F.count("*").alias("targets"))


@query(
    "rel_semi_and_anti_join",
    """
SELECT p_partkey, EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 49) AS sold_in_bulk FROM part""",
)
def semi_and_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    bulk = table(spark, sf, "lineitem").filter("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    parts = table(spark, sf, "part").select("p_partkey")
    return parts.join(bulk, "p_partkey", "left_semi").withColumn("sold_in_bulk", F.lit(True)).unionByName(
        parts.join(bulk, "p_partkey", "left_anti").withColumn("sold_in_bulk", F.lit(False))
    )


@query(
    "rel_union_distinct",
    """
SELECT lower(split_part(split_part(url, '://', 2), '/', 1)) AS host FROM pages
UNION SELECT 's' || s_suppkey || '.example' FROM supplier""",
)
def union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    captured = table(spark, sf, "pages").select(U.host("url").alias("host"))
    known = table(spark, sf, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string"), F.lit(".example")).alias("host")
    )
    return captured.unionByName(known).distinct()


@query(
    "rel_case_and_try_cast",
    """
SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 'traffic' WHEN event_type LIKE 'pur%' THEN 'sale'
  ELSE 'other' END AS kind, try_cast(event_type AS INTEGER) IS NULL AS no_number,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE value BETWEEN 10 AND 60 AND event_type NOT LIKE 'err%'""",
)
def case_and_try_cast(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    rows = table(spark, sf, "events").filter(F.col("value").between(10, 60) & ~kind.like("err%"))
    return rows.select(
        "event_id",
        F.when(kind.isin("view", "click"), "traffic").when(kind.like("pur%"), "sale").otherwise("other").alias("kind"),
        kind.try_cast("int").isNull().alias("no_number"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )


@query(
    "rel_map_and_json_keys",
    """
SELECT k AS field, count(*) AS events, min(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS low FROM
  (SELECT props, unnest(json_keys(props)) AS k FROM events) GROUP BY 1""",
)
def map_and_json_keys(spark: SparkSession, sf: str) -> DataFrame:
    held = table(spark, sf, "events").select(F.from_json("props", "map<string,string>").alias("m"))
    fields = held.select("m", F.explode(F.map_keys("m")).alias("field"))
    return fields.groupBy("field").agg(
        F.count("*").alias("events"), F.min(F.try_element_at("m", F.lit("k")).cast("long")).alias("low")
    )


@query(
    "rel_top_pages",
    """
WITH a AS (SELECT page_id, len(regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1)) AS links FROM pages)
SELECT page_id, links FROM a ORDER BY links DESC, page_id LIMIT 20""",
)
def top_pages(spark: SparkSession, sf: str) -> DataFrame:
    links = F.size(T.all_tags("html", T.LINK_TAG)).cast("long")
    return page_table(spark, sf).select("page_id", links.alias("links")).orderBy(F.desc("links"), "page_id").limit(20)


@query(
    "rel_string_and_array_functions",
    """
SELECT doc_id, len(string_split(text, ' ')) AS words, left(text, 10) AS head, regexp_replace(text, '[0-9]', '#', 'g')
  AS masked, printf('%d-%s', doc_id, lang) AS tag FROM documents""",
)
def string_functions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id",
        F.size(F.split("text", " ")).cast("long").alias("words"),
        F.left("text", F.lit(10)).alias("head"),
        F.regexp_replace("text", "[0-9]", "#").alias("masked"),
        F.format_string("%d-%s", "doc_id", "lang").alias("tag"),
    )


@query(
    "rel_fresh_by_age",
    """
SELECT o_orderkey, TIMESTAMP '1998-08-02' - o_orderdate > INTERVAL 7 DAY AS older_than_week FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-08-02' - INTERVAL 90 DAY""",
)
def fresh_by_age(spark: SparkSession, sf: str) -> DataFrame:
    as_of = F.lit("1998-08-02 00:00:00").cast("timestamp_ntz")
    recent = table(spark, sf, "orders").filter(F.col("o_orderdate") >= as_of - F.expr("interval 90 days"))
    return recent.select("o_orderkey", (as_of - F.col("o_orderdate") > F.expr("interval '7' day")).alias("older_than_week"))


@query(
    "rel_lookup_of_hot_keys",
    "SELECT event_id, c_name FROM events LEFT JOIN customer ON user_id % 3 = c_custkey",
)
def lookup_of_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Every key is asked for by a third of all rows; the salted lookup spreads them."""
    asked = table(spark, sf, "events").select("event_id", (F.col("user_id") % 3).alias("c_custkey"))
    names = table(spark, sf, "customer").select("c_custkey", "c_name")
    return lookup(asked, names, "c_custkey").select("event_id", "c_name")
