"""Page scans, frontiers, robots and schedules."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions import url as U
from pageloom.operators import frontier as FR
from pageloom.operators import pages as P
from pageloom.operators import robots as RB
from pageloom.operators import schedule as SC
from pageloom.plans.registry import query
from pageloom.plans.response_queries import ADAPTIVE_DELAYS, ATTEMPTS, attempt_log, rounded_delays
from pageloom.session import checkpoint_dir
from pageloom.sources import sitemap as SM
from pageloom.sources.tables import page_table, response_store, spread, table

_SEEDS = """
WITH seeds AS (SELECT page_id, unnest([url, url || '?missing', NULL, '']) AS url FROM pages)
"""


def seeds(spark: SparkSession, sf: str) -> DataFrame:
    """Every page URL, an uncaptured one, a NULL and an empty one."""
    u = F.col("url")
    return page_table(spark, sf).select(
        F.explode(F.array(u, F.concat(u, F.lit("?missing")), F.lit(None), F.lit(""))).alias("url"), "page_id"
    )


@query(
    "s01_s05_s10_page_scan",
    _SEEDS
    + """
SELECT DISTINCT s.url, CASE WHEN p.url IS NOT NULL THEN 200 END AS status,
  CASE WHEN p.url IS NULL THEN 'not_captured' END AS error, length(p.html) AS chars, 1 AS depth
FROM seeds s LEFT JOIN pages p ON s.url = p.url WHERE s.url <> ''""",
)
def page_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = P.scan(P.seed_urls(seeds(spark, sf)), page_store(spark, sf))
    return found.select("url", "status", "error", F.length("body").cast("long").alias("chars"), "depth")


def page_store(spark: SparkSession, sf: str) -> DataFrame:
    """The captured pages, one entry per URL (the highest page number wins)."""
    pages = page_table(spark, sf)
    latest = pages.groupBy("url").agg(F.max("page_id").alias("page_id"))
    return response_store(pages.join(latest, ["url", "page_id"], "left_semi"))


@query(
    "s02_s03_lookup_each",
    _SEEDS
    + """
SELECT s.page_id, s.url, CASE WHEN p.url IS NOT NULL THEN 200 END AS status,
  CASE WHEN s.url IS NULL THEN 'NULL URL' WHEN p.url IS NULL THEN 'not_captured' END AS error
FROM seeds s LEFT JOIN (SELECT DISTINCT url FROM pages) p ON s.url = p.url
WHERE s.url IS NULL OR s.url <> ''""",
)
def lookup_each(spark: SparkSession, sf: str) -> DataFrame:
    found = P.lookup_each(seeds(spark, sf), page_store(spark, sf))
    return found.select("page_id", "url", "status", "error")


@query(
    "u21_redirect_columns",
    """
SELECT page_id, url || '?old' AS url, url AS final_url, CAST(page_id % 3 AS INTEGER) AS redirect_count FROM pages""",
)
def redirect_columns(spark: SparkSession, sf: str) -> DataFrame:
    store = response_store(page_table(spark, sf)).select(
        F.concat("url", F.lit("?old")).alias("url"), "status", "content_type", "body", "error", "response_time_ms",
        F.col("url").alias("final_url"),
    )
    store = store.dropDuplicates(["url"])
    seeds_ = page_table(spark, sf).select(
        F.concat("url", F.lit("?old")).alias("url"), "page_id", (F.col("page_id") % 3).cast("int").alias("redirect_count")
    )
    return P.lookup_each(seeds_, store).select("page_id", "url", "final_url", "redirect_count")


def order_graph(spark: SparkSession, sf: str) -> DataFrame:
    """Links customer page -> order pages -> part pages -> supplier pages."""
    orders = table(spark, sf, "orders")
    items = table(spark, sf, "lineitem")

    def name(letter: str, key: str) -> Column:
        return F.concat(F.lit(letter), F.col(key).cast("string"))

    none = F.lit(False)
    return (
        orders.select(name("c", "o_custkey").alias("src_url"), name("o", "o_orderkey").alias("dst_url"), none.alias("nofollow"))
        .unionByName(
            items.select(
                name("o", "l_orderkey").alias("src_url"),
                name("p", "l_partkey").alias("dst_url"),
                (F.col("l_linenumber") % 3 == 0).alias("nofollow"),
            )
        )
        .unionByName(
            items.select(name("p", "l_partkey").alias("src_url"), name("s", "l_suppkey").alias("dst_url"), none.alias("nofollow"))
        )
    )


_GRAPH = """
WITH RECURSIVE edges AS (
  SELECT 'c' || o_custkey AS src_url, 'o' || o_orderkey AS dst_url, false AS nofollow FROM orders
  UNION SELECT 'o' || l_orderkey, 'p' || l_partkey, l_linenumber % 3 = 0 FROM lineitem
  UNION SELECT 'p' || l_partkey, 's' || l_suppkey, false FROM lineitem),
walk AS (SELECT 'c' || c_custkey AS url, 1 AS depth FROM customer WHERE c_nationkey = 3
  UNION SELECT e.dst_url, w.depth + 1 FROM walk w JOIN edges e ON e.src_url = w.url
  WHERE w.depth < {depth} {only})
"""


def graph_seeds(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").filter("c_nationkey = 3")
    return customers.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("url"))


@query(
    "f01_follow_links",
    _GRAPH.format(depth=3, only="") + "SELECT url, min(depth) AS depth FROM walk GROUP BY 1",
)
def follow_links(spark: SparkSession, sf: str) -> DataFrame:
    return FR.follow(order_graph(spark, sf), graph_seeds(spark, sf), 3)


@query(
    "f06_follow_without_nofollow",
    _GRAPH.format(depth=4, only="AND NOT e.nofollow") + "SELECT url, min(depth) AS depth FROM walk GROUP BY 1",
)
def follow_without_nofollow(spark: SparkSession, sf: str) -> DataFrame:
    return FR.follow(order_graph(spark, sf), graph_seeds(spark, sf), 4, skip_nofollow=True)


@query(
    "f02_result_cap",
    _GRAPH.format(depth=2, only="")
    + "SELECT url, min(depth) AS depth FROM walk GROUP BY 1 ORDER BY 2, 1 LIMIT 30",
)
def result_cap(spark: SparkSession, sf: str) -> DataFrame:
    return FR.first_results(FR.follow(order_graph(spark, sf), graph_seeds(spark, sf), 2), 30)


def sitemap_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Index per region, index per nation, sitemap per 500 customer numbers of a nation."""
    region, nation, customer = (table(spark, sf, t) for t in ("region", "nation", "customer"))

    def text(c: str | Column) -> Column:
        return (F.col(c) if isinstance(c, str) else c).cast("string")

    def document(root: str, parts: Column) -> Column:
        return F.concat(
            F.lit(f'<?xml version="1.0"?><{root} xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'),
            F.array_join(F.array_sort(parts), ""),
            F.lit(f"</{root}>"),
        )

    site = F.lit("https://maps.example/")
    regions = region.join(nation, F.col("r_regionkey") == F.col("n_regionkey")).groupBy("r_regionkey").agg(
        document(
            "sitemapindex",
            F.collect_list(
                F.concat(F.lit("<sitemap><loc> "), site, F.lit("n"), text("n_nationkey"), F.lit(".xml </loc></sitemap>"))
            ),
        ).alias("xml")
    ).select(F.concat(site, F.lit("r"), text("r_regionkey"), F.lit(".xml")).alias("sitemap_url"), "xml")
    # Children are cut by key range, so a sitemap stays short at any scale.
    block = F.floor(F.col("c_custkey") / 500)
    keyed = customer.withColumn("block", block)
    maps = keyed.groupBy("c_nationkey", "block").agg(
        document(
            "urlset",
            F.collect_list(
                F.concat(
                    F.lit("<url><loc>https://shop.example/c?id="), text("c_custkey"),
                    F.lit("&amp;x=1</loc><lastmod>2024-01-"), F.lpad(text(F.col("c_custkey") % 28 + 1), 2, "0"),
                    F.lit("</lastmod><changefreq>"), F.when(F.col("c_custkey") % 2 == 0, "daily").otherwise("weekly"),
                    F.lit("</changefreq>"),
                    F.when(F.col("c_custkey") % 3 == 0, "<priority>0.8</priority>").otherwise(""),
                    F.lit("</url>"),
                )
            ),
        ).alias("xml")
    )
    name = F.concat(site, F.lit("n"), text("c_nationkey"), F.lit("-"), text("block"), F.lit(".xml"))
    leaves = maps.select(name.alias("sitemap_url"), "xml")
    nations = keyed.select("c_nationkey", "block").distinct().groupBy("c_nationkey", F.floor(F.col("block") / 50000)).agg(
        document(
            "sitemapindex",
            F.collect_list(F.concat(F.lit("<sitemap><loc>"), name, F.lit("</loc><lastmod>2024-02-01</lastmod></sitemap>"))),
        ).alias("xml")
    ).select(F.concat(site, F.lit("n"), text("c_nationkey"), F.lit(".xml")).alias("sitemap_url"), "xml")
    return regions.unionByName(nations).unionByName(leaves)


_ENTRIES = """
SELECT 'https://shop.example/c?id=' || c_custkey || '&x=1' AS url,
  '2024-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') AS lastmod,
  CASE WHEN c_custkey % 2 = 0 THEN 'daily' ELSE 'weekly' END AS changefreq,
  CASE WHEN c_custkey % 3 = 0 THEN CAST(0.8 AS DOUBLE) END AS priority FROM customer
"""


@query("s06_s07_sitemap_entries", _ENTRIES)
def sitemap_entries(spark: SparkSession, sf: str) -> DataFrame:
    return SM.entries(sitemap_documents(spark, sf)).drop("sitemap_url")


@query("s08_gzipped_sitemaps", _ENTRIES)
def gzipped_sitemaps(spark: SparkSession, sf: str) -> DataFrame:
    """Sitemaps written as gzipped text, one document per line, and read again."""
    folder = f"{checkpoint_dir(spark)}/gzip-{uuid.uuid4().hex}"
    leaves = sitemap_documents(spark, sf).filter("xml like '%<urlset%'")
    leaves.select("xml").write.option("compression", "gzip").text(folder)
    documents = spark.read.text(folder).select(F.lit("gz").alias("sitemap_url"), F.col("value").alias("xml"))
    return SM.entries(documents).drop("sitemap_url")


@query(
    "f03_sitemap_recursion",
    _ENTRIES + " JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2",
)
def sitemap_recursion(spark: SparkSession, sf: str) -> DataFrame:
    start = table(spark, sf, "region").filter("r_regionkey = 2").select(
        F.concat(F.lit("https://maps.example/r"), F.col("r_regionkey").cast("string"), F.lit(".xml")).alias("sitemap_url")
    )
    return SM.read_sitemaps(start, sitemap_documents(spark, sf)).drop("sitemap_url")


@query(
    "f04_common_sitemap_locations",
    """
WITH paths AS (SELECT unnest(['/sitemap.xml', '/sitemap_index.xml', '/sitemap-index.xml', '/sitemapindex.xml',
  '/sitemap/sitemap.xml', '/sitemaps/sitemap.xml', '/sitemap1.xml', '/sitemap-1.xml', '/post-sitemap.xml',
  '/page-sitemap.xml', '/product-sitemap.xml', '/category-sitemap.xml', '/wp-sitemap.xml']) AS path)
SELECT 'https://s' || s_suppkey || '.example' || path AS sitemap_url FROM supplier, paths
WHERE s_suppkey % 2 = 0 AND path LIKE '%index%'""",
)
def common_locations(spark: SparkSession, sf: str) -> DataFrame:
    hosts = table(spark, sf, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string"), F.lit(".example")).alias("host"), "s_suppkey"
    )
    candidates = SM.candidate_locations(hosts.select("host"))
    captured = SM.candidate_locations(hosts.filter("s_suppkey % 2 = 0").select("host")).filter(
        "sitemap_url like '%index%'"
    )
    return candidates.join(captured, "sitemap_url", "left_semi").select("sitemap_url")


_STALE_SQL = """
WITH e AS (SELECT o_orderkey AS url, o_custkey, o_orderdate AS crawled,
  o_orderdate + to_days(CAST(o_orderkey % 3 - 1 AS INTEGER)) AS lastmod,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'always' WHEN '2-HIGH' THEN 'daily' WHEN '3-MEDIUM' THEN 'monthly'
    WHEN '5-LOW' THEN 'never' END AS freq FROM orders),
d AS (SELECT *, lastmod > crawled OR date_diff('second', crawled, TIMESTAMP '1998-01-01') >
  3600 * CASE freq WHEN 'always' THEN 0 WHEN 'daily' THEN 24 WHEN 'monthly' THEN 720 WHEN 'never' THEN 87600
  ELSE 168 END AS stale FROM e)
"""


def sitemap_orders(spark: SparkSession, sf: str) -> DataFrame:
    word = F.create_map(
        *[F.lit(x) for x in ("1-URGENT", "always", "2-HIGH", "daily", "3-MEDIUM", "monthly", "5-LOW", "never")]
    )
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("url"),
        (F.col("o_orderdate") + F.make_dt_interval(days=(F.col("o_orderkey") % 3 - 1).cast("int"))).alias("lastmod"),
        F.try_element_at(word, F.col("o_orderpriority")).alias("changefreq"),
        F.col("o_orderdate").alias("crawled"),
    )


def visit_time() -> Column:
    return F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")


@query("f07_stale_by_sitemap", _STALE_SQL + "SELECT url, stale FROM d")
def stale_by_sitemap(spark: SparkSession, sf: str) -> DataFrame:
    due = FR.is_stale(F.col("lastmod"), F.col("changefreq"), F.col("crawled"), visit_time())
    return sitemap_orders(spark, sf).select("url", due.alias("stale"))


@query(
    "f08_new_before_stale",
    _STALE_SQL
    + """
SELECT url, CASE WHEN url % 5 = 0 THEN 1 ELSE 2 END AS kind FROM d WHERE url % 5 = 0 OR stale""",
)
def new_before_stale(spark: SparkSession, sf: str) -> DataFrame:
    entries = sitemap_orders(spark, sf)
    state = entries.filter("url % 5 <> 0").select("url", F.col("crawled").alias("crawled_at"))
    plan = FR.visit_plan(entries, state, visit_time())
    return plan.select("url", "kind").orderBy("kind", "url")


@query(
    "k10_sitemap_cache",
    """
SELECT 'host' || (o_custkey % 10) AS hostname, o_clerk AS url, max(o_orderkey) AS seq FROM
  (SELECT *, 'u' || (o_orderkey % 97) AS o_clerk FROM orders
   WHERE o_orderdate > TIMESTAMP '1998-06-01' - INTERVAL 17520 HOUR) GROUP BY 1, 2""",
)
def sitemap_cache(spark: SparkSession, sf: str) -> DataFrame:
    from pageloom.operators.snapshot import fresh_entries, upsert_latest

    seen = table(spark, sf, "orders").select(
        F.concat(F.lit("host"), (F.col("o_custkey") % 10).cast("string")).alias("hostname"),
        F.concat(F.lit("u"), (F.col("o_orderkey") % 97).cast("string")).alias("url"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderdate").alias("discovered_at"),
    )
    as_of = F.lit("1998-06-01 00:00:00").cast("timestamp_ntz")
    fresh = fresh_entries(seen, as_of, 17520, "discovered_at")
    merged = upsert_latest(fresh.filter("seq % 2 = 0"), fresh.filter("seq % 2 = 1"), ["hostname", "url"], "seq")
    return merged.select("hostname", "url", "seq")


@query(
    "f19_canonical_collapse",
    """
SELECT min(url) AS first_url, count(*) AS pages, regexp_extract(url, '^[a-z]+://[^/]*') ||
  regexp_extract(url, '^[a-z]+://[^/]*(/[a-z]+/)', 1) AS page_url FROM pages GROUP BY 3""",
)
def canonical_collapse(spark: SparkSession, sf: str) -> DataFrame:
    from pageloom.functions import tags as T

    folder = F.regexp_extract("url", "^[a-z]+://[^/]*(/[a-z]+/)", 1)
    head = F.concat(F.lit("<head><link rel='canonical' href='"), folder, F.lit("'>"))
    pages = page_table(spark, sf).withColumn("html", F.regexp_replace("html", "<head>", head))
    return FR.collapse_canonical(pages.select("url", T.canonical("html", "url").alias("canonical")))


# --- robots -------------------------------------------------------------------

AGENT = "LoomBot/1.0"


def robots_files(spark: SparkSession, sf: str) -> DataFrame:
    """A robots file per supplier host in one of three styles."""
    n, k = F.col("s_nationkey").cast("string"), F.col("s_suppkey").cast("string")
    star = F.concat(
        F.lit("# rules\nUser-agent: *\r\nDisallow: /n"), n, F.lit("\n  Allow: /n"), n, F.lit("/open\nDisallow:\nCrawl-delay: "),
        (F.col("s_suppkey") % 5 + 1).cast("string"), F.lit("\nRequest-rate: 2/"), (F.col("s_suppkey") % 13 + 1).cast("string"),
        F.lit("\n"),
    )
    named = F.when(F.col("s_suppkey") % 3 == 1, "user-agent: LOOMBOT\nDisallow: /*.pdf$\n").when(
        F.col("s_suppkey") % 3 == 2,
        F.concat(F.lit("User-Agent: loom\nDisallow: /\nAllow: /n"), n, F.lit("\nUser-agent: other\nDisallow: /\nCrawl-delay: 99\n")),
    ).otherwise("")
    body = F.concat(star, named, F.lit("SITEMAP: https://s"), k, F.lit(".example/map.xml\n"))
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("s"), k, F.lit(".example")).alias("host"), body.alias("body")
    )


_RULES = """
WITH g AS (SELECT s_suppkey AS k, s_nationkey AS n, 's' || s_suppkey || '.example' AS host FROM supplier),
rules AS (
  SELECT host, '*' AS agent, 'disallow' AS kind, '/n' || n AS value FROM g
  UNION ALL SELECT host, '*', 'allow', '/n' || n || '/open' FROM g
  UNION ALL SELECT host, '*', 'crawl-delay', CAST(k % 5 + 1 AS VARCHAR) FROM g
  UNION ALL SELECT host, '*', 'request-rate', '2/' || (k % 13 + 1) FROM g
  UNION ALL SELECT host, 'loombot', 'disallow', '/*.pdf$' FROM g WHERE k % 3 = 1
  UNION ALL SELECT host, 'loom', 'disallow', '/' FROM g WHERE k % 3 = 2
  UNION ALL SELECT host, 'loom', 'allow', '/n' || n FROM g WHERE k % 3 = 2
  UNION ALL SELECT host, 'other', 'disallow', '/' FROM g WHERE k % 3 = 2
  UNION ALL SELECT host, 'other', 'crawl-delay', '99' FROM g WHERE k % 3 = 2
  UNION ALL SELECT host, NULL, 'sitemap', 'https://' || host || '/map.xml' FROM g)
"""


@query("r01_robots_rules", _RULES + "SELECT * FROM rules")
def robots_rules(spark: SparkSession, sf: str) -> DataFrame:
    return RB.rules(robots_files(spark, sf)).drop("line_no")


@query(
    "r02_chosen_group",
    _RULES
    + "SELECT host, CASE k % 3 WHEN 0 THEN '*' WHEN 1 THEN 'loombot' ELSE 'loom' END AS agent FROM g",
)
def chosen_group(spark: SparkSession, sf: str) -> DataFrame:
    return RB.chosen_agent(robots_files(spark, sf), AGENT)


def item_urls(spark: SparkSession, sf: str) -> DataFrame:
    """A URL per order line on the host of its supplier."""
    page = F.concat(
        F.lit("https://s"), F.col("l_suppkey").cast("string"), F.lit(".example/n"), (F.col("l_partkey") % 25).cast("string"),
        F.when(F.col("l_linenumber") % 3 == 0, "/open/").otherwise("/shut/"), F.col("l_orderkey").cast("string"),
        F.when(F.col("l_linenumber") % 2 == 0, ".pdf").otherwise(".html"),
    )
    return spread(table(spark, sf, "lineitem")).select(page.alias("url"))


_ITEM_URLS = """
WITH u AS (SELECT l_suppkey, 's' || l_suppkey || '.example' AS host, '/n' || (l_partkey % 25) ||
    CASE WHEN l_linenumber % 3 = 0 THEN '/open/' ELSE '/shut/' END || l_orderkey ||
    CASE WHEN l_linenumber % 2 = 0 THEN '.pdf' ELSE '.html' END AS path FROM lineitem),
j AS (SELECT u.*, '/n' || s_nationkey AS n FROM u JOIN supplier ON l_suppkey = s_suppkey)
"""


@query(
    "r03_prefix_verdict",
    _ITEM_URLS
    + """
SELECT host, path, CASE l_suppkey % 3 WHEN 0 THEN starts_with(path, n || '/open') OR NOT starts_with(path, n)
  WHEN 1 THEN true ELSE starts_with(path, n) END AS allowed, count(*) AS urls FROM j GROUP BY 1, 2, 3""",
)
def prefix_verdict(spark: SparkSession, sf: str) -> DataFrame:
    judged = RB.with_verdict(item_urls(spark, sf), robots_files(spark, sf), AGENT, longest_match=False)
    return judged.groupBy("host", U.path("url").alias("path"), "allowed").agg(F.count("*").alias("urls"))


_LONGEST = """CASE l_suppkey % 3 WHEN 0 THEN starts_with(path, n || '/open') OR NOT starts_with(path, n)
  WHEN 1 THEN NOT path LIKE '%.pdf' ELSE starts_with(path, n) END"""


@query(
    "r04_longest_match_verdict",
    _ITEM_URLS + f"SELECT host, path, {_LONGEST} AS allowed, count(*) AS urls FROM j GROUP BY 1, 2, 3",
)
def longest_verdict(spark: SparkSession, sf: str) -> DataFrame:
    judged = RB.with_verdict(item_urls(spark, sf), robots_files(spark, sf), AGENT)
    return judged.groupBy("host", U.path("url").alias("path"), "allowed").agg(F.count("*").alias("urls"))


@query(
    "r09_robots_filter",
    _ITEM_URLS
    + f"""
SELECT count(*) AS urls, count(*) FILTER (WHERE {_LONGEST}) AS kept,
  count(*) FILTER (WHERE NOT {_LONGEST}) AS disallowed FROM j""",
)
def robots_filter(spark: SparkSession, sf: str) -> DataFrame:
    urls, robots = item_urls(spark, sf), robots_files(spark, sf)
    marked = RB.mark_disallowed(urls, robots, AGENT)
    return marked.agg(
        F.count("*").alias("urls"),
        F.count(F.when(F.col("status").isNull(), 1)).alias("kept"),
        F.count(F.when(F.col("error_class") == "robots_disallowed", 1)).alias("disallowed"),
    )


@query(
    "r05_crawl_delay",
    "SELECT 's' || s_suppkey || '.example' AS host, CAST(s_suppkey % 5 + 1 AS DOUBLE) AS crawl_delay FROM supplier",
)
def crawl_delay(spark: SparkSession, sf: str) -> DataFrame:
    return RB.crawl_delay(robots_files(spark, sf), AGENT)


@query(
    "r06_r07_effective_delay",
    """
SELECT 's' || s_suppkey || '.example' AS host, '*' AS agent, CAST(s_suppkey % 5 + 1 AS DOUBLE) AS crawl_delay,
  (s_suppkey % 13 + 1) / 2.0 AS request_rate, greatest(s_suppkey % 5 + 1.0, (s_suppkey % 13 + 1) / 2.0)
  AS effective_delay FROM supplier""",
)
def effective_delay(spark: SparkSession, sf: str) -> DataFrame:
    return RB.group_delays(robots_files(spark, sf)).filter("agent = '*'")


@query(
    "r08_robots_sitemaps",
    """
SELECT 's' || s_suppkey || '.example' AS host, 'https://s' || s_suppkey || '.example/map.xml' AS sitemap_url
FROM supplier""",
)
def robots_sitemaps(spark: SparkSession, sf: str) -> DataFrame:
    return RB.sitemaps(robots_files(spark, sf))


# --- schedules ----------------------------------------------------------------


@query(
    "f09_f18_earliest_offsets",
    ATTEMPTS
    + """
SELECT seq, domain, (row_number() OVER (PARTITION BY domain ORDER BY seq) - 1) * 250 AS earliest_ms
FROM attempts""",
)
def earliest_offsets(spark: SparkSession, sf: str) -> DataFrame:
    planned = SC.earliest_offsets(attempt_log(spark, sf).select("seq", "domain"), F.lit(250))
    return planned.orderBy("earliest_ms", "seq")


@query(
    "f10_delay_clamp",
    """
SELECT s_suppkey, least(greatest(coalesce(CASE WHEN s_suppkey % 4 > 0 THEN s_suppkey / 3.0 END, 1.0), 0.5), 20.0)
  AS delay FROM supplier""",
)
def delay_clamp(spark: SparkSession, sf: str) -> DataFrame:
    robots_delay = F.when(F.col("s_suppkey") % 4 > 0, F.col("s_suppkey") / F.lit(3.0))
    return table(spark, sf, "supplier").select(
        "s_suppkey", SC.clamped_delay(robots_delay, 1.0, 0.5, 20.0).alias("delay")
    )


@query(
    "f11_fetch_waves",
    ATTEMPTS
    + """
SELECT seq, CAST(floor((row_number() OVER (PARTITION BY domain ORDER BY seq) - 1)
  / CASE WHEN domain LIKE '%1.example' THEN 1 ELSE 8 END) AS BIGINT) AS wave FROM attempts""",
)
def fetch_waves(spark: SparkSession, sf: str) -> DataFrame:
    urls = attempt_log(spark, sf).select(
        "seq", "domain", F.when(F.col("domain").like("%1.example"), 2.0).alias("robots_delay")
    )
    return SC.fetch_waves(urls, 8).select("seq", "wave")


@query(
    "f13_backoff",
    """
WITH fib AS (SELECT unnest([3, 3, 6, 9, 15, 24, 39, 63, 100, 100, 100, 100]) AS seconds, unnest(range(12)) AS n)
SELECT c_custkey, CAST(seconds AS INTEGER) AS seconds FROM customer JOIN fib ON c_custkey % 12 = n""",
)
def backoff(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey", SC.backoff_seconds(F.col("c_custkey") % 12, 100).alias("seconds")
    )


@query(
    "f14_domain_blocks",
    ATTEMPTS
    + """
, f AS (SELECT *, status = 429 OR status <= 0 OR status BETWEEN 500 AND 504 AS failed,
  coalesce(try_cast(nullif(regexp_extract(retry_after, '^[0-9]+'), '') AS BIGINT), 0) AS asked FROM attempts),
g AS (SELECT *, sum(CASE WHEN failed THEN 0 ELSE 1 END) OVER (PARTITION BY domain ORDER BY seq) AS grp FROM f),
r AS (SELECT *, CAST(sum(CASE WHEN failed THEN 1 ELSE 0 END) OVER (PARTITION BY domain, grp ORDER BY seq)
  AS BIGINT) AS run FROM g)
SELECT seq, domain, run AS failures_in_row, CASE WHEN failed THEN CASE WHEN asked > 0 THEN asked
  ELSE CAST(([3, 3, 6, 9, 15, 24, 39, 63, 102, 165, 267, 432, 600])[least(run, 12) + 1] AS BIGINT) END END
  AS blocked_seconds FROM r""",
)
def domain_blocks(spark: SparkSession, sf: str) -> DataFrame:
    blocks = SC.domain_blocks(attempt_log(spark, sf).select("seq", "domain", "status", "retry_after"))
    return blocks.select("seq", "domain", "failures_in_row", "blocked_seconds")


@query(
    "f14_retry_cap",
    ATTEMPTS
    + """
SELECT 'u' || (seq % 200) AS url, count(*) FILTER (WHERE status = 429 OR status <= 0 OR status BETWEEN 500 AND 504)
  AS retries, count(*) FILTER (WHERE status = 429 OR status <= 0 OR status BETWEEN 500 AND 504) > 5 AS given_up
FROM attempts GROUP BY 1""",
)
def retry_cap(spark: SparkSession, sf: str) -> DataFrame:
    log = attempt_log(spark, sf).select(
        F.concat(F.lit("u"), (F.col("seq") % 200).cast("string")).alias("url"), "status"
    )
    return SC.retry_verdicts(log)


@query(
    "f17_domain_counters",
    ATTEMPTS
    + """
SELECT domain, count(*) FILTER (WHERE status BETWEEN 200 AND 299) AS crawled,
  count(*) FILTER (WHERE status >= 400 OR status = 0) AS failed, CAST(0 AS BIGINT) AS skipped
FROM attempts GROUP BY 1""",
)
def domain_counters(spark: SparkSession, sf: str) -> DataFrame:
    return SC.domain_counters(attempt_log(spark, sf))


@query("f12_adaptive_delay", ADAPTIVE_DELAYS)
def adaptive_delay(spark: SparkSession, sf: str) -> DataFrame:
    return rounded_delays(SC.adaptive_delays(attempt_log(spark, sf)))


# --- crawls with rules on the way ----------------------------------------------


def shop_store(spark: SparkSession, sf: str) -> DataFrame:
    """Customer pages that link to order pages, which link to part pages; an entry is cached on the day of the order."""
    orders, items = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    shop = F.concat(F.lit("https://shop"), (F.col("o_custkey") % 7).cast("string"), F.lit(".example"))
    order_url = F.concat(shop, F.lit("/o/"), F.col("o_orderkey").cast("string"))
    order_date = F.col("o_orderdate").cast("timestamp").alias("cached_at")
    homes = orders.groupBy(F.concat(shop, F.lit("/c/"), F.col("o_custkey").cast("string")).alias("url")).agg(
        F.concat_ws("", F.sort_array(F.collect_list(F.concat(F.lit('<a href="/o/'), F.col("o_orderkey").cast("string"), F.lit('">o</a>'))))).alias("body")
    )
    parts = items.groupBy("l_orderkey").agg(
        F.concat_ws("", F.collect_list(F.concat(F.lit('<a href="//parts.example/p/'), F.col("l_partkey").cast("string"), F.lit('">p</a>')))).alias("body")
    )
    lists = orders.join(parts, orders["o_orderkey"] == parts["l_orderkey"]).select(order_url.alias("url"), "body", order_date)
    pages = homes.withColumn("cached_at", F.lit("2030-01-01").cast("timestamp")).unionByName(lists)
    return pages.select(
        "url", F.lit(200).alias("status"), F.lit("text/html").alias("content_type"), "body",
        F.lit(None).cast("string").alias("error"), F.lit(0).cast("long").alias("response_time_ms"), "cached_at",
    )


def shop_seeds(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_custkey")
    shop = F.concat(F.lit("https://shop"), (key % 7).cast("string"), F.lit(".example/c/"), key.cast("string"))
    return table(spark, sf, "orders").select(shop.alias("url")).distinct()


# ``led`` names the orders whose pages may be led through, ``held`` those whose pages are not captured.
_SHOP = """
WITH o AS (SELECT o_custkey, o_orderkey, o_orderdate, 'https://shop' || (o_custkey % 7) || '.example' AS shop FROM orders),
p AS (SELECT l_orderkey, sum(length('<a href="//parts.example/p/' || l_partkey || '">p</a>')) AS size FROM lineitem GROUP BY 1),
x AS (SELECT o.*, size, {error} AS error FROM o LEFT JOIN p ON l_orderkey = o_orderkey),
r AS (
  SELECT DISTINCT shop || '/c/' || o_custkey AS url, 1 AS depth, 200 AS status, CAST(NULL AS VARCHAR) AS error FROM o
  UNION SELECT shop || '/o/' || o_orderkey, 2, CASE WHEN error = 'robots_disallowed' THEN -1 WHEN error IS NULL OR error = 'content_too_large' THEN 200 END, error FROM x
  UNION SELECT 'https://parts.example/p/' || l_partkey, 3, NULL, 'not_captured' FROM x JOIN lineitem ON l_orderkey = o_orderkey WHERE error IS NULL)
SELECT url, depth, status, error FROM r"""


def _crawled(spark: SparkSession, sf: str, **rules: object) -> DataFrame:
    return P.crawl(shop_seeds(spark, sf), shop_store(spark, sf), 3, **rules).select("url", "depth", "status", "error")


@query(
    "s01_crawl_robots",
    _SHOP.format(error="CASE WHEN shop IN ('https://shop1.example', 'https://shop3.example') AND starts_with('/o/' || o_orderkey, '/o/1') "
                 "THEN 'robots_disallowed' WHEN size IS NULL THEN 'not_captured' END"),
)
def crawl_robots(spark: SparkSession, sf: str) -> DataFrame:
    """Order pages that a robots file forbids are named, and no part is reached through them alone."""
    files = table(spark, sf, "orders").select((F.col("o_custkey") % 7).alias("k")).distinct().select(
        F.concat(F.lit("shop"), F.col("k").cast("string"), F.lit(".example")).alias("host"),
        F.when(F.col("k").isin(1, 3), "User-agent: *\nDisallow: /o/1\n").otherwise("User-agent: other\nDisallow: /\n").alias("body"),
    )
    return _crawled(spark, sf, robots=files)


@query(
    "s01_crawl_cache_age",
    _SHOP.format(error="CASE WHEN size IS NULL OR CAST(o_orderdate AS TIMESTAMP) < TIMESTAMP '1996-01-01' - INTERVAL 720 DAY THEN 'not_captured' END"),
)
def crawl_cache_age(spark: SparkSession, sf: str) -> DataFrame:
    """Order pages of an old cache entry count as not captured and are not led through."""
    return _crawled(spark, sf, as_of=F.lit("1996-01-01").cast("timestamp"), ttl_hours=720 * 24)


@query(
    "s01_crawl_body_size",
    """
WITH o AS (SELECT o_custkey, o_orderkey, 'https://shop' || (o_custkey % 7) || '.example' AS shop FROM orders),
h AS (SELECT o_custkey, sum(length('<a href="/o/' || o_orderkey || '">o</a>')) > 150 AS large FROM o GROUP BY 1),
p AS (SELECT l_orderkey, sum(length('<a href="//parts.example/p/' || l_partkey || '">p</a>')) > 150 AS long FROM lineitem GROUP BY 1),
x AS (SELECT o.*, large, long FROM o JOIN h USING (o_custkey) LEFT JOIN p ON l_orderkey = o_orderkey)
SELECT DISTINCT shop || '/c/' || o_custkey AS url, 1 AS depth, 200 AS status, CASE WHEN large THEN 'content_too_large' END AS error FROM x
UNION SELECT shop || '/o/' || o_orderkey, 2, CASE WHEN long IS NOT NULL THEN 200 END,
  CASE WHEN long THEN 'content_too_large' WHEN long IS NULL THEN 'not_captured' END FROM x WHERE NOT large
UNION SELECT 'https://parts.example/p/' || l_partkey, 3, NULL, 'not_captured'
  FROM x JOIN lineitem ON l_orderkey = o_orderkey WHERE NOT large AND NOT long""",
)
def crawl_body_size(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with a body over the limit lose it, so nothing is reached through them."""
    return _crawled(spark, sf, max_bytes=150)
