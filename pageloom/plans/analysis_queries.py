"""Sample analyses on extracted data and the normalisation jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions import dom as D
from pageloom.functions import fields as FL
from pageloom.functions import json_path as J
from pageloom.functions.columns import unpack
from pageloom.functions.htmlpath import htmlpath
from pageloom.operators import pages as P
from pageloom.operators import quality as Q
from pageloom.operators.running import lookup, previous_value
from pageloom.plans import documents as DOC
from pageloom.plans.registry import query
from pageloom.sources.tables import table


def price_log(spark: SparkSession, sf: str) -> DataFrame:
    """Orders read as price checks of a page per customer."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("page"),
        F.col("o_orderkey").alias("seq"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
    )


_LOG = """
WITH p AS (SELECT o_custkey AS page, o_orderkey AS seq, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
"""


@query(
    "price_history_lag",
    _LOG
    + """
, l AS (SELECT *, lag(cents) OVER (PARTITION BY page ORDER BY seq) AS previous FROM p)
SELECT page, seq, cents, previous, cents - previous AS change FROM l WHERE cents <> previous""",
)
def price_history(spark: SparkSession, sf: str) -> DataFrame:
    marked = previous_value(price_log(spark, sf), ["page"], "seq", "cents", "previous")
    return marked.withColumn("change", F.col("cents") - F.col("previous")).filter("change <> 0")


@query(
    "price_change_between_crawls",
    _LOG
    + """
, r AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY seq DESC) AS rn FROM p)
SELECT c.page, c.cents AS current_cents, b.cents AS previous_cents, c.cents - b.cents AS change,
  round((c.cents - b.cents) * 100.0 / b.cents, 2)::DOUBLE AS change_percent
FROM r c JOIN r b ON c.page = b.page AND c.rn = 1 AND b.rn = 2 WHERE c.cents <> b.cents""",
)
def price_change(spark: SparkSession, sf: str) -> DataFrame:
    """Last two checks per page by two partial aggregates, without a window."""
    log = price_log(spark, sf)
    current = log.groupBy("page").agg(F.max("seq").alias("last_seq"), F.max_by("cents", "seq").alias("current_cents"))
    earlier = lookup(log, current.select("page", "last_seq"), "page", "inner").filter("seq < last_seq")
    previous = earlier.groupBy("page").agg(F.max_by("cents", "seq").alias("previous_cents"))
    change = F.col("current_cents") - F.col("previous_cents")
    return (
        current.join(previous, "page")
        .filter("current_cents <> previous_cents")
        .select(
            "page",
            "current_cents",
            "previous_cents",
            change.alias("change"),
            F.round(change.cast("decimal(18,1)") * F.lit(100) / F.col("previous_cents"), 2).cast("double").alias("change_percent"),
        )
    )


@query(
    "authors_by_posts",
    """
SELECT source AS author, count(*) AS posts, CAST(floor(avg(n_chars)) AS BIGINT) AS avg_chars, min(doc_id) AS first_post,
  max(doc_id) AS latest_post FROM documents WHERE source IS NOT NULL GROUP BY 1""",
)
def authors_by_posts(spark: SparkSession, sf: str) -> DataFrame:
    posts = table(spark, sf, "documents").filter("source is not null")
    return (
        posts.groupBy(F.col("source").alias("author"))
        .agg(
            F.count("*").alias("posts"),
            F.floor(F.avg("n_chars")).cast("long").alias("avg_chars"),
            F.min("doc_id").alias("first_post"),
            F.max("doc_id").alias("latest_post"),
        )
        .orderBy(F.desc("posts"))
    )


@query(
    "post_reading_time",
    """
SELECT doc_id, len(string_split(text, ' ')) AS words, CAST(greatest(1, len(string_split(text, ' ')) // 200) AS BIGINT) || ' min read'
  AS reading_time, left(text, 150) || '...' AS preview FROM documents WHERE length(text) > 500""",
)
def reading_time(spark: SparkSession, sf: str) -> DataFrame:
    words = F.size(F.split("text", " ")).cast("long")
    return table(spark, sf, "documents").filter(F.length("text") > 500).select(
        "doc_id",
        words.alias("words"),
        F.concat(F.greatest(F.lit(1), F.floor(words / 200)).cast("string"), F.lit(" min read")).alias("reading_time"),
        F.concat(F.left("text", F.lit(150)), F.lit("...")).alias("preview"),
    )


_SHOWS = """
WITH shows AS (SELECT event_id, event_type AS city, ts AS starts, user_id % 5 = 0 AS online,
  CASE WHEN user_id % 7 = 0 THEN 'SoldOut' WHEN user_id % 7 = 1 THEN 'InStock' END AS availability,
  CAST(round(value * 100) AS BIGINT) AS cents FROM events)
"""


def shows(spark: SparkSession, sf: str) -> DataFrame:
    """Events read as announced shows."""
    u = F.col("user_id")
    return table(spark, sf, "events").select(
        "event_id",
        F.col("event_type").alias("city"),
        F.col("ts").alias("starts"),
        (u % 5 == 0).alias("online"),
        F.when(u % 7 == 0, "SoldOut").when(u % 7 == 1, "InStock").alias("availability"),
        F.round(F.col("value") * 100).cast("long").alias("cents"),
    )


@query(
    "upcoming_events",
    _SHOWS
    + """
SELECT event_id, CASE WHEN online THEN 'Online' ELSE city END AS location FROM shows
WHERE starts >= TIMESTAMP '2024-01-02 00:00:00' AND (availability IS NULL OR availability NOT LIKE '%SoldOut%')
ORDER BY starts, event_id LIMIT 50""",
)
def upcoming_events(spark: SparkSession, sf: str) -> DataFrame:
    as_of = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    open_shows = shows(spark, sf).filter(
        (F.col("starts") >= as_of) & (F.col("availability").isNull() | ~F.col("availability").like("%SoldOut%"))
    )
    location = F.when(F.col("online"), "Online").otherwise(F.col("city"))
    return open_shows.orderBy("starts", "event_id").limit(50).select("event_id", location.alias("location"))


@query(
    "events_by_city",
    _SHOWS
    + """
SELECT city, count(*) AS shows, min(event_id) AS first_show, min(cents) AS cheapest, sum(cents)::BIGINT AS total_cents
FROM shows WHERE starts >= TIMESTAMP '2024-01-02 00:00:00' AND city IS NOT NULL AND NOT online GROUP BY 1""",
)
def events_by_city(spark: SparkSession, sf: str) -> DataFrame:
    as_of = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    return (
        shows(spark, sf)
        .filter((F.col("starts") >= as_of) & F.col("city").isNotNull() & ~F.col("online"))
        .groupBy("city")
        .agg(
            F.count("*").alias("shows"),
            F.min("event_id").alias("first_show"),
            F.min("cents").alias("cheapest"),
            F.sum("cents").alias("total_cents"),
        )
    )


@query(
    "price_statistics",
    """
SELECT count(*) AS products, printf('%.2f', min(c) / 100.0) AS min_price, printf('%.2f', floor(avg(c)) / 100.0) AS avg_price,
  printf('%.2f', max(c) / 100.0) AS max_price FROM (SELECT CAST(round(p_retailprice * 100) AS BIGINT) AS c FROM part)""",
)
def price_statistics(spark: SparkSession, sf: str) -> DataFrame:
    cents = table(spark, sf, "part").select(F.round(F.col("p_retailprice") * 100).cast("long").alias("c"))

    def money(value: Column) -> Column:
        return F.format_string("%.2f", value / F.lit(100.0))

    return cents.agg(
        F.count("*").alias("products"),
        money(F.min("c")).alias("min_price"),
        money(F.floor(F.avg("c"))).alias("avg_price"),
        money(F.max("c")).alias("max_price"),
    )


@query(
    "script_array_flattening",
    "SELECT o_orderkey AS id, o_orderstatus AS status, o_orderkey % 2 = 0 AS is_even FROM orders",
)
def script_array(spark: SparkSession, sf: str) -> DataFrame:
    from pageloom.functions import script_vars as S

    held = DOC.order_pages(spark, sf).select(S.variables("html").alias("v"))
    orders = F.from_json(F.col("v")["orders"], "array<struct<id: long, status: string, even: boolean>>")
    rows = unpack(held, [], orders, "i", "o")
    return rows.select("o.id", "o.status", F.col("o.even").alias("is_even"))


@query(
    "two_stage_lookup",
    """
SELECT CAST(floor(p_partkey / 20) AS BIGINT) AS page, 'https://shop.example/p/' || p_partkey AS url, '"' || p_name || '"' AS title,
  '"SKU-' || p_partkey || '"' AS sku FROM part""",
)
def two_stage_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Listing pages name the detail pages, which are looked up in the store."""
    listing = DOC.card_pages(spark, sf).withColumn("dom", D.parse("html"))
    ids = unpack(listing, ["page"], J.array_items(htmlpath("html", "input#jobs@value[*].id", "dom")), "i", "id")
    wanted = ids.select("page", F.concat(F.lit("https://shop.example/p/"), "id").alias("url"))
    store = DOC.product_pages(spark, sf).select(
        "url",
        F.lit(200).alias("status"),
        F.lit("text/html").alias("content_type"),
        F.col("html").alias("body"),
        F.lit(None).cast("string").alias("error"),
        F.lit(0).cast("long").alias("response_time_ms"),
    )
    details = P.lookup_each(wanted, store).filter("status = 200").withColumn("dom", D.parse("body"))
    return details.select(
        "page",
        "url",
        htmlpath("body", "h1.name@text", "dom").alias("title"),
        htmlpath("body", "[data-sku]@data-sku", "dom").alias("sku"),
    )


# --- normalisation ------------------------------------------------------------

_MESSY = """
WITH m AS (SELECT p_partkey AS k, CAST(round(p_retailprice * 100) AS BIGINT) AS c, p_size AS s, p_name, p_brand FROM part)
"""


def messy_products(spark: SparkSession, sf: str) -> DataFrame:
    """Product texts in the spellings found on pages."""
    k, size = F.col("p_partkey"), F.col("p_size")
    cents = F.round(F.col("p_retailprice") * 100).cast("long")
    whole, rest = F.floor(cents / 100).cast("string"), F.lpad((cents % 100).cast("string"), 2, "0")
    grouped = F.format_number(F.floor(cents / 100), 0)
    return table(spark, sf, "part").select(
        "p_partkey",
        F.when(k % 4 == 0, DOC.glue("€", whole, ",", rest))
        .when(k % 4 == 1, DOC.glue("$", grouped, ".", rest))
        .when(k % 4 == 2, DOC.glue("USD ", whole))
        .otherwise("Price: 0.00 £")
        .alias("price_text"),
        F.when(k % 4 == 0, DOC.glue("Cola ", size, " x 330ml"))
        .when(k % 4 == 1, DOC.glue("Rice ", size, ",5 kg bag"))
        .when(k % 4 == 2, DOC.glue("Spice ", size, "G"))
        .otherwise("Gift card")
        .alias("size_text"),
        F.element_at(
            F.array(*map(F.lit, ("In Stock", "Only 2 left", "SOLD OUT - low stock", "https://schema.org/PreOrder", "???"))),
            (k % 5 + 1).cast("int"),
        ).alias("stock_text"),
    )


@query(
    "n01_price_normalised",
    _MESSY
    + """
SELECT k AS p_partkey, CAST(CASE k % 4 WHEN 0 THEN c / 100.0 WHEN 1 THEN c / 100.0 WHEN 2 THEN c // 100 END AS DOUBLE) AS amount,
  CASE k % 4 WHEN 0 THEN 'EUR' WHEN 3 THEN 'GBP' ELSE 'USD' END AS currency, k % 4 = 3 AS is_zero FROM m""",
)
def price_normalised(spark: SparkSession, sf: str) -> DataFrame:
    held = messy_products(spark, sf).select("p_partkey", FL.price("price_text").alias("p"))
    return held.select("p_partkey", F.col("p.amount").cast("double").alias("amount"), "p.currency", "p.is_zero")


@query(
    "n02_quantity_normalised",
    _MESSY
    + """
SELECT k AS p_partkey, CASE k % 4 WHEN 0 THEN 'ml' WHEN 1 THEN 'g' WHEN 2 THEN 'g' END AS base_unit,
  CAST(CASE k % 4 WHEN 0 THEN s * 330 WHEN 1 THEN s * 1000 + 500 WHEN 2 THEN s END AS DOUBLE) AS total,
  CASE WHEN k % 4 = 0 THEN (c / 100.0)::DOUBLE * 1000.0::DOUBLE / (s * 330)::DOUBLE END AS per_liter FROM m""",
)
def quantity_normalised(spark: SparkSession, sf: str) -> DataFrame:
    held = messy_products(spark, sf).select(
        "p_partkey", FL.quantity("size_text").alias("q"), FL.parse_price("price_text").alias("amount")
    )
    per_liter = F.when(F.col("q.base_unit") == "ml", FL.unit_price("amount", F.col("q.total")))
    return held.select("p_partkey", "q.base_unit", "q.total", per_liter.alias("per_liter"))


@query(
    "n03_stock_status",
    """
SELECT p_partkey, (['IN_STOCK', 'IN_STOCK', 'OUT_OF_STOCK', 'PRE_ORDER', 'OUT_OF_STOCK'])[CAST(p_partkey % 5 + 1 AS INTEGER)]
  AS stock FROM part""",
)
def stock_status(spark: SparkSession, sf: str) -> DataFrame:
    return messy_products(spark, sf).select("p_partkey", FL.stock_status("stock_text").alias("stock"))


@query(
    "n04_validated_products",
    """
SELECT p_partkey, CASE p_partkey % 4 WHEN 3 THEN '["price","size"]' ELSE '[]' END AS failed FROM part""",
)
def validated_products(spark: SparkSession, sf: str) -> DataFrame:
    rows = messy_products(spark, sf).select(
        "p_partkey", FL.price("price_text")["amount"].alias("amount"), FL.quantity("size_text")["total"].alias("total")
    )
    good, bad = Q.validate(rows, {"price": F.col("amount") > 0, "size": F.col("total") >= 0})
    return good.select("p_partkey", F.lit("[]").alias("failed")).unionByName(
        bad.select("p_partkey", F.to_json("failed_checks").alias("failed"))
    )


@query(
    "n05_health_metrics",
    """
WITH d AS (SELECT event_type AS source, strftime(ts, '%Y-%m-%d') AS day, count(*) AS rows,
    count(*) FILTER (WHERE value > 50)::DOUBLE / count(*) AS valid_ratio, count(props)::DOUBLE / count(*) AS props_coverage
  FROM events GROUP BY 1, 2),
l AS (SELECT *, lag(rows) OVER (PARTITION BY source ORDER BY day) AS previous_rows FROM d)
SELECT source, day, rows, round(valid_ratio, 6) AS valid_ratio, props_coverage, previous_rows,
  coalesce(rows < previous_rows * 0.5, false) AS dropped FROM l""",
)
def health_metrics(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").withColumnRenamed("event_type", "source")
    report = Q.health(rows, "source", F.date_format("ts", "yyyy-MM-dd"), F.col("value") > 50, ["props"])
    return report.withColumn("valid_ratio", F.round("valid_ratio", 6))


@query(
    "n06_same_code",
    """
WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 3 > 0 THEN CAST(p_partkey % 50 AS VARCHAR) END AS gtin FROM part)
SELECT p_partkey, coalesce(min(p_partkey) OVER (PARTITION BY gtin), 0) * CASE WHEN gtin IS NULL THEN 0 ELSE 1 END
  + CASE WHEN gtin IS NULL THEN p_partkey ELSE 0 END AS entity FROM p""",
)
def same_code(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    products = table(spark, sf, "part").select("p_partkey", F.when(k % 3 > 0, (k % 50).cast("string")).alias("gtin"))
    return Q.same_code(products, "p_partkey", "gtin").select("p_partkey", "entity")


@query(
    "n06_near_names",
    """
WITH n AS (SELECT DISTINCT p_brand, trim(regexp_replace(lower(p_name || ', ' || p_size), '[^a-z0-9]+', ' ', 'g')) AS name FROM part)
SELECT a.p_brand, a.name AS name_a, b.name AS name_b FROM n a JOIN n b ON a.p_brand = b.p_brand AND a.name < b.name
WHERE levenshtein(a.name, b.name) <= 1""",
)
def near_names(spark: SparkSession, sf: str) -> DataFrame:
    titles = table(spark, sf, "part").select("p_brand", F.concat_ws(", ", "p_name", "p_size").alias("title"))
    return Q.near_names(titles, ["p_brand"], "title")


@query(
    "n06_similar_names",
    """
WITH n AS (SELECT DISTINCT p_brand, p_size % 5 AS weight, trim(regexp_replace(lower(p_name || ', ' || p_size), '[^a-z0-9]+', ' ', 'g')) AS name FROM part)
SELECT a.p_brand, a.weight, a.name AS name_a, b.name AS name_b
FROM n a JOIN n b ON a.p_brand = b.p_brand AND a.weight = b.weight AND a.name < b.name
WHERE 1 - levenshtein(a.name, b.name) / greatest(length(a.name), length(b.name)) > 0.9""",
)
def similar_names(spark: SparkSession, sf: str) -> DataFrame:
    title = F.concat_ws(", ", "p_name", "p_size").alias("title")
    titles = table(spark, sf, "part").select("p_brand", (F.col("p_size") % 5).alias("weight"), title)
    return Q.similar_names(titles, ["p_brand", "weight"], "title")


@query(
    "n07_other_transforms",
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, (o_orderkey % 5 + 0.5)::DOUBLE AS rating,
  o_orderkey || ', b & ' || o_orderpriority AS clean, o_orderstatus || ', ' || o_orderkey AS joined,
  (o_orderkey % 2 = 0) AS flag FROM orders""",
)
def other_transforms(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    spelled = (
        F.when(k % 3 == 0, F.date_format("o_orderdate", "d.M.yyyy"))
        .when(k % 3 == 1, F.date_format("o_orderdate", "d MMM yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format(FL.parse_date(spelled), "yyyy-MM-dd").alias("day"),
        FL.extract_number(F.concat(F.lit("Rating: "), (k % 5).cast("string"), F.lit(",5/5"))).alias("rating"),
        FL.clean_text(F.concat(F.lit(" <b>"), k.cast("string"), F.lit("</b>,\n b &amp;  "), "o_orderpriority", F.lit(" "))).alias("clean"),
        FL.join_array(F.array("o_orderstatus", k.cast("string"))).alias("joined"),
        FL.to_boolean(F.when(k % 2 == 0, " Yes").otherwise("OFF")).alias("flag"),
    )


@query(
    "x32_text_transforms",
    """
SELECT doc_id, lower(t) AS low, upper(t) AS up, 'b' || doc_id AS bare FROM
  (SELECT doc_id, 'Straight ' || lang || ' Text' AS t FROM documents)""",
)
def text_transforms(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.lit("\t Straight "), "lang", F.lit(" Text \n"))
    tagged = F.concat(F.lit("<i>b</i>"), F.col("doc_id").cast("string"))
    return table(spark, sf, "documents").select(
        "doc_id",
        FL.TRANSFORMS["lowercase"](FL.trim(text)).alias("low"),
        FL.TRANSFORMS["uppercase"](FL.trim(text)).alias("up"),
        FL.strip_html(tagged).alias("bare"),
    )
