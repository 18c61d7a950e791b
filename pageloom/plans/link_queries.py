"""Links and head fields of the captured pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions import tags as T
from pageloom.functions import url as U
from pageloom.functions.sql_names import register
from pageloom.operators import extract as E
from pageloom.operators import pages as P
from pageloom.plans.registry import query
from pageloom.sources.tables import page_table, response_store, table

# Independent statement of the links: every link of the test pages is quoted and
# starts with one slash.
_LINKS = """
WITH t AS (
  SELECT page_id, url, regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'),
    '<script[^>]*>.*?</script', '', 'gs') AS body FROM pages),
a AS (SELECT page_id, url, unnest(regexp_extract_all(body, '<a\\s[^>]*href="([^"]*)"', 1)) AS href FROM t),
l AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/]*') || href AS link FROM a
  WHERE href LIKE '/%')
"""


@query(
    "x23_links",
    _LINKS + "SELECT page_id, link, count(*) AS times FROM l GROUP BY 1, 2",
)
def links(spark: SparkSession, sf: str) -> DataFrame:
    found = T.links(page_table(spark, sf), ["page_id", "url"])
    return found.groupBy("page_id", "link").agg(F.count("*").alias("times"))


@query(
    "x23b_distinct_links",
    _LINKS + "SELECT DISTINCT page_id, split_part(link, '#', 1) AS link, false AS nofollow FROM l",
)
def distinct_links(spark: SparkSession, sf: str) -> DataFrame:
    return T.distinct_links(page_table(spark, sf), ["page_id"]).select(
        "page_id", "link", "nofollow"
    )


_ANCHORS = """
WITH b AS (SELECT page_id, regexp_extract(url, '^(.*?://[^/?#]*)', 1) AS o,
  regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1) AS p FROM pages)
SELECT page_id, CAST(k AS INTEGER) AS pos, link, k % 2 = 1 AS nofollow FROM (SELECT page_id, unnest([0, 1, 2, 3, 4, 7]) AS k, unnest([
  o || '/x?a=1&b=' || page_id, o || '/login?next=https://other.example/' || page_id, o || '/gt',
  o || '/up/', o || p || '?p=2', 'https://other.example/' || page_id || '?q=%27%22']) AS link FROM b)"""


def anchor_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The captured pages behind anchors with known targets, skipped ones among them."""
    page = F.col("page_id").cast("string")
    anchors = F.concat(
        F.lit('<a href="/x?a=1&amp;b='), page, F.lit('">1</a><a rel=nofollow href="/login?next=https://other.example/'), page,
        F.lit("\">2</a><!-- <a href='/no'> --><a title=\"a > b\" href=\"/gt\">3</a><a rel='x nofollow' href='/up/y/..'>4</a>"),
        F.lit('<a href="?p=2">5</a><a href="mailto:a@b.example">6</a><a href="#top">7</a><A REL="NOFOLLOW" HREF=" https://other.example/'),
        page, F.lit('?q=&#39;&quot; ">8</A><script>var a = \'<a href="/no">\';</script><a name=x><a href="/x?a=1&#38;b='),
        page, F.lit('#again">9</a><style>never closed <a href="/no">'),
    )
    return page_table(spark, sf).withColumn("html", F.concat(F.lit("<body>"), anchors))


@query("x23_known_anchors", _ANCHORS)
def known_anchors(spark: SparkSession, sf: str) -> DataFrame:
    """Entities, schemes inside queries, quoted brackets, dot segments; repeated links count once."""
    pages = anchor_pages(spark, sf).withColumn("url", F.regexp_replace("url", "[?#].*$", ""))
    return T.distinct_links(pages, ["page_id"], base="url").select("page_id", "pos", "link", "nofollow")


_SPELLINGS = """
WITH b AS (SELECT page_id, regexp_extract(url, '^(.*?://[^/?#]*)', 1) AS o FROM pages),
l AS (SELECT page_id, unnest(range(13)) AS k, unnest([
  'https://other.example/café/' || page_id, 'http://h.example/b/' || page_id || '?x=A',
  o || '/né/€' || page_id, o || '/s%20p/%7Bx%7D?q=%22a%20b%22#f%20g', o || '/?a=1&copy=2&b=' || page_id || '¬',
  'https://u:P@h.example:8443/', 'https://h.example/?q', o || '/a//c/', o || '/😀/…|�',
  'http://h.example/x/' || page_id, o || '/back/slash', o || '/line' || page_id, 'https://h.example/%2e%2eb/.c/']) AS link FROM b)
SELECT page_id, way, link FROM l, (SELECT unnest(['tag', 'tree']) AS way)"""


def spelled_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Captured pages behind anchors whose targets are spelled in other ways than the URL standard has them."""
    page = F.col("page_id").cast("string")
    hrefs = [
        ("HTTPS://Other.Example:443/x/../caf&eacute;/", ""),
        ("http://H.EXAMPLE:80/a/./b/../../b/", "?x=A"),
        ("/n&#233;/&#x20AC;", ""),
        ('/s p/{x}?q=&quot;a b&quot;#f g"', None),
        ("/?a=1&copy=2&amp;b=", "&not"),
        ("https://u:P@H.example:8443", None),
        ("https://h.example?q", None),
        ("/a//b/../c/%2E", None),
        ("/&#128512;/&#133;|&#xD800;", None),
        ("HTTP:h.example/x/", ""),
        ("\\back\\slash", None),
        (" /li\nne", "\t "),
        ("https://h.example/x/%2e%2e/%2e%2eb/.c/", None),
    ]
    anchors = [F.concat(F.lit(f'<a href="{a.rstrip(chr(34))}'), *([page, F.lit(z)] if z is not None else []), F.lit('">x</a>')) for a, z in hrefs]
    pages = page_table(spark, sf).withColumn("html", F.concat(F.lit("<body>"), *anchors))
    return pages.withColumn("url", F.regexp_replace("url", "^http:", "https:"))


@query("x23_standard_links", _SPELLINGS.replace("SELECT page_id, regexp_extract(url,", "SELECT page_id, regexp_extract(regexp_replace(url, '^http:', 'https:'),"))
def standard_links(spark: SparkSession, sf: str) -> DataFrame:
    """Both ways to read links give the one spelling of the URL standard, references decoded."""
    pages = spelled_pages(spark, sf)
    by_tag = T.links(pages, ["page_id", "url"]).select("page_id", F.lit("tag").alias("way"), "link")
    by_tree = E.selected_links(pages, ["page_id", "url"]).select("page_id", F.lit("tree").alias("way"), "link")
    return by_tag.unionByName(by_tree)


@query(
    "flagship_links_per_host",
    _LINKS
    + """
, d AS (SELECT DISTINCT page_id, lower(split_part(split_part(url, '://', 2), '/', 1)) AS host,
  split_part(link, '#', 1) AS link FROM l)
SELECT host, count(DISTINCT page_id) AS pages, count(*) AS links, count(DISTINCT link) AS targets
FROM d GROUP BY 1""",
)
def links_per_host(spark: SparkSession, sf: str) -> DataFrame:
    """One pass over the pages; the distinct counts combine before each shuffle."""
    pages = page_table(spark, sf).withColumn("host", U.host("url"))
    found = T.distinct_links(pages, ["page_id", "host"], base="url")
    return found.groupBy("host").agg(
        F.countDistinct("page_id").alias("pages"),
        F.count("*").alias("links"),
        F.countDistinct("link").alias("targets"),
    )


@query(
    "page_titles",
    """
WITH f AS (SELECT page_id, nullif(trim(regexp_extract(html, '<title>(.*?)</title>', 1, 's')), '') AS title,
  nullif(trim(regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')), '') AS heading FROM pages)
SELECT page_id, replace(replace(replace(replace(replace(title, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''),
  '&amp;', '&') AS title, replace(replace(replace(replace(replace(heading, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
  '&#x27;', ''''), '&amp;', '&') AS heading FROM f""",
)
def page_titles(spark: SparkSession, sf: str) -> DataFrame:
    return page_table(spark, sf).select(
        "page_id", T.title("html").alias("title"), T.heading("html").alias("heading")
    )


@query(
    "x23c_tag_attributes",
    """
SELECT page_id, 'v' || page_id AS quoted, 'w' || page_id AS single_quoted, 'b' || page_id AS bare,
  CAST(NULL AS VARCHAR) AS missing FROM pages""",
)
def tag_attributes(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("page_id").cast("string")
    tag = F.concat(
        F.lit('<A DATA-one="v'), n, F.lit("\" data-two = 'w"), n, F.lit("' data-three=b"), n, F.lit(">")
    )
    return page_table(spark, sf).select(
        "page_id",
        T.attribute(tag, "data-one").alias("quoted"),
        T.attribute(tag, "data-two").alias("single_quoted"),
        T.attribute(tag, "data-three").alias("bare"),
        T.attribute(tag, "two").alias("missing"),
    )


@query(
    "x23d_canonical",
    """
SELECT page_id, CASE WHEN page_id % 2 = 0 THEN regexp_extract(url, '^[a-z]+://[^/]*') || '/c/' || page_id
  || '?a=1&b=2' END AS canonical FROM pages""",
)
def canonical(spark: SparkSession, sf: str) -> DataFrame:
    head = F.concat(
        F.lit("<head><link rel=stylesheet href=/s.css>"),
        F.when(
            F.col("page_id") % 2 == 0,
            F.concat(
                F.lit('<LINK REL="Canonical" HREF="/c/'),
                F.col("page_id").cast("string"),
                F.lit('?a=1&amp;b=2">'),
            ),
        ).otherwise(""),
    )
    pages = page_table(spark, sf).withColumn("html", F.regexp_replace("html", "<head>", head))
    return pages.select("page_id", T.canonical("html", "url").alias("canonical"))


@query(
    "x23e_robots_meta",
    "SELECT page_id, page_id % 2 = 0 AS nofollow, page_id % 4 = 0 AS noindex FROM pages",
)
def robots_meta(spark: SparkSession, sf: str) -> DataFrame:
    content = F.when(F.col("page_id") % 4 == 0, "noindex, NOFOLLOW").when(
        F.col("page_id") % 2 == 0, "nofollow"
    ).otherwise("index")
    head = F.concat(F.lit('<head><meta name="robots" content="'), content, F.lit('">'))
    pages = page_table(spark, sf).withColumn("html", F.regexp_replace("html", "<head>", head))
    return pages.select(
        "page_id", T.has_nofollow("html").alias("nofollow"), T.has_noindex("html").alias("noindex")
    )


@query(
    "x23_selected_links",
    """
WITH n AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]*') AS origin,
  unnest(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'), '<a href="(/[^"]*)"', 1)) AS href FROM pages)
SELECT page_id, origin || replace(replace(href, '&quot;', '"'), '&amp;', '&') AS link, count(*) AS times FROM n GROUP BY 1, 2""",
)
def selected_links(spark: SparkSession, sf: str) -> DataFrame:
    found = E.selected_links(page_table(spark, sf), ["page_id"], "nav > ul > li a[href]")
    return found.groupBy("page_id", "link").agg(F.count("*").alias("times"))


@query(
    "s01_f01_crawl_with_follow",
    _LINKS
    + """
, p AS (SELECT DISTINCT url FROM pages)
SELECT url, 1 AS depth, CAST(NULL AS VARCHAR) AS error FROM p
UNION ALL SELECT DISTINCT link, 2, 'not_captured' FROM l WHERE link NOT IN (SELECT url FROM p)""",
)
def crawl_with_follow(spark: SparkSession, sf: str) -> DataFrame:
    pages = page_table(spark, sf)
    store = response_store(pages.dropDuplicates(["url"]))
    return P.crawl(pages.select("url"), store, max_depth=2).select("url", "depth", "error")


@query(
    "rel_sql_text_functions",
    """
WITH t AS (
  SELECT page_id, url, regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<script[^>]*>.*?</script', '', 'gs') AS body FROM pages),
a AS (SELECT page_id, url, unnest(regexp_extract_all(body, '<a\\s[^>]*href="([^"]*)"', 1)) AS href FROM t)
SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/:?#]*)', 1)) AS host, count(*) AS links, count(DISTINCT href) AS targets,
  min(href) AS first_href FROM a GROUP BY ALL""",
)
def sql_text_functions(spark: SparkSession, sf: str) -> DataFrame:
    """A query in SQL text: elements by a table function, URL parts by SQL functions."""
    register(spark)
    return spark.sql(
        f"""
        SELECT p.page_id, url_host(p.url) AS host, count(*) AS links, count(DISTINCT e.attrs['href']) AS targets,
          min(e.attrs['href']) AS first_href
        FROM parquet.`{sf}/pages.parquet` p, LATERAL page_elements(p.html) e
        WHERE e.tag = 'a' AND e.attrs['href'] IS NOT NULL AND url_is_usable(p.url)
        GROUP BY p.page_id, url_host(p.url)"""
    )
