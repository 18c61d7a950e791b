"""URL expressions over page URLs and spelling variants of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions import url as U
from pageloom.plans.registry import query
from pageloom.sources.tables import table


def url_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Nine spellings of every page URL, some of them unusable."""
    u = F.col("url")
    page = F.col("page_id").cast("string")
    variants = F.array(
        u,
        F.regexp_replace(u, "://", "://www."),
        F.regexp_replace(u, "^(https?://[^/]+)", "$1:8080"),
        F.concat(F.lit("ftp://files.example/"), page),
        F.lit(""),
        F.upper(u),
        F.concat(F.lit("http://h"), page, F.lit("?a/b#c")),
        F.concat(F.lit("http:///"), page),
        F.concat(F.lit("http://bad host/"), page),
    )
    return table(spark, sf, "pages").select("page_id", F.posexplode(variants).alias("k", "u"))


_VARIANTS = """
WITH v AS (
  SELECT page_id, CAST(unnest(range(9)) AS INTEGER) AS k, unnest([
    url, replace(url, '://', '://www.'), regexp_replace(url, '^(https?://[^/]+)', '\\1:8080'),
    'ftp://files.example/' || page_id, '', upper(url), 'http://h' || page_id || '?a/b#c',
    'http:///' || page_id, 'http://bad host/' || page_id]) AS u
  FROM pages),
r AS (SELECT *, contains(u, '://') AS has, CASE WHEN contains(u, '://')
  THEN substr(u, instr(u, '://') + 3) ELSE '' END AS rest FROM v)
"""


@query(
    "u01_validation_error",
    _VARIANTS
    + """
SELECT page_id, k, CASE
  WHEN u = '' THEN 'URL is empty'
  WHEN strlen(u) > 8192 THEN 'URL exceeds maximum length of 8192'
  WHEN NOT (lower(u) LIKE 'http://%' OR lower(u) LIKE 'https://%')
    THEN 'URL must start with http:// or https://'
  WHEN regexp_extract(rest, '^([^/:?]*)', 1) = '' THEN 'URL has no hostname'
  WHEN contains(split_part(rest, '/', 1), ' ') THEN 'URL hostname contains invalid character'
  ELSE '' END AS problem
FROM r""",
)
def validation(spark: SparkSession, sf: str) -> DataFrame:
    return url_variants(spark, sf).select("page_id", "k", U.validation_error("u").alias("problem"))


@query(
    "u02_domain",
    _VARIANTS
    + "SELECT page_id, k, split_part(split_part(rest, '/', 1), ':', 1) AS domain FROM r",
)
def domain(spark: SparkSession, sf: str) -> DataFrame:
    return url_variants(spark, sf).select("page_id", "k", U.domain("u").alias("domain"))


@query(
    "u03_path",
    _VARIANTS
    + """
SELECT page_id, k, CASE WHEN contains(rest, '/') THEN substr(rest, instr(rest, '/'))
  ELSE '/' END AS path FROM r""",
)
def path(spark: SparkSession, sf: str) -> DataFrame:
    return url_variants(spark, sf).select("page_id", "k", U.path("u").alias("path"))


@query(
    "u04_host",
    _VARIANTS
    + """
SELECT page_id, k, lower(split_part(CASE WHEN contains(rest, '/') THEN split_part(rest, '/', 1)
  WHEN contains(rest, '?') THEN split_part(rest, '?', 1) ELSE split_part(rest, '#', 1) END,
  ':', 1)) AS host FROM r""",
)
def host(spark: SparkSession, sf: str) -> DataFrame:
    return url_variants(spark, sf).select("page_id", "k", U.host("u").alias("host"))


@query(
    "u05_bare_path",
    _VARIANTS
    + """
, p AS (SELECT page_id, k, CASE WHEN contains(rest, '/') THEN substr(rest, instr(rest, '/'))
  ELSE '/' END AS path FROM r)
SELECT page_id, k, CASE WHEN contains(path, '?') THEN split_part(path, '?', 1)
  ELSE split_part(path, '#', 1) END AS bare_path FROM p""",
)
def bare_path(spark: SparkSession, sf: str) -> DataFrame:
    return url_variants(spark, sf).select("page_id", "k", U.bare_path("u").alias("bare_path"))


@query(
    "u06_base_domain",
    _VARIANTS
    + """
, h AS (SELECT page_id, k, lower(split_part(split_part(rest, '/', 1), ':', 1)) AS h FROM r)
SELECT page_id, k, CASE WHEN h LIKE 'www._%' THEN substr(h, 5) ELSE h END AS base FROM h""",
)
def base_domain(spark: SparkSession, sf: str) -> DataFrame:
    return url_variants(spark, sf).select(
        "page_id", "k", U.base_domain(U.domain("u")).alias("base")
    )


_SURT_HOST = """
, h AS (SELECT *, lower(split_part(split_part(rest, '/', 1), ':', 1)) AS h FROM r),
b AS (SELECT *, CASE WHEN h LIKE 'www.%' THEN substr(h, 5) ELSE h END AS bare FROM h),
s AS (SELECT *, array_to_string(list_reverse(string_split(bare, '.')), ',') || ')' AS labels FROM b)
"""


@query(
    "u07_surt",
    _VARIANTS
    + _SURT_HOST
    + """
SELECT page_id, k, CASE WHEN has THEN labels || CASE WHEN contains(rest, '/')
  THEN substr(rest, instr(rest, '/')) ELSE '/' END ELSE u END AS surt FROM s""",
)
def surt(spark: SparkSession, sf: str) -> DataFrame:
    return url_variants(spark, sf).select("page_id", "k", U.surt("u").alias("surt"))


@query(
    "u08_domain_surt",
    _VARIANTS
    + _SURT_HOST
    + """
SELECT labels AS domain_surt, count(*) AS urls FROM s WHERE h <> '' GROUP BY 1""",
)
def domain_surt(spark: SparkSession, sf: str) -> DataFrame:
    hosts = url_variants(spark, sf).select(U.domain("u").alias("h")).filter("h <> ''")
    return hosts.groupBy(U.domain_surt("h").alias("domain_surt")).agg(F.count("*").alias("urls"))


_HREFS = """
WITH v AS (
  SELECT page_id, url, CAST(unnest(range(10)) AS INTEGER) AS k, unnest([
    'p' || page_id || '.html', '../up', './same/', '../../../top', 'a//b/./c/../d', '?page=' || page_id,
    '/abs/../x', '//cdn.example/' || page_id, ' https://other.example/' || page_id || ' ', '']) AS href
  FROM pages),
b AS (SELECT *, trim(href) AS h, regexp_extract(url, '^(.*?://[^/]*)', 1) AS origin,
  regexp_extract(url, '^(.*?:)//', 1) AS scheme,
  regexp_replace(regexp_replace(regexp_extract(url, '^.*?://[^/]*(/.*)$', 1), '[?#].*$', ''), '[^/]*$', '') AS folder
  FROM v),
c AS (SELECT *, folder || h AS whole FROM b),
f AS (SELECT *, list_reduce(list_concat([CAST([] AS VARCHAR[])],
    list_transform(string_split(whole, '/'), lambda p: [p])),
    lambda a, x: CASE WHEN x[1] IN ('', '.') THEN a WHEN x[1] = '..' THEN a[1:len(a) - 1]
      ELSE list_concat(a, x) END) AS parts FROM c),
g AS (SELECT *, '/' || array_to_string(parts, '/') AS joined FROM f)
"""


@query(
    "u09_resolve",
    _HREFS
    + """
SELECT page_id, k, CASE WHEN h = '' THEN '' WHEN contains(h, '://') THEN h
  WHEN h LIKE '//%' THEN scheme || h WHEN h LIKE '/%' THEN origin || h
  ELSE origin || joined || CASE WHEN whole LIKE '%_/' AND joined NOT LIKE '%/' THEN '/' ELSE '' END
  END AS link FROM g""",
)
def resolve(spark: SparkSession, sf: str) -> DataFrame:
    page = F.col("page_id").cast("string")
    hrefs = F.array(
        F.concat(F.lit("p"), page, F.lit(".html")),
        F.lit("../up"),
        F.lit("./same/"),
        F.lit("../../../top"),
        F.lit("a//b/./c/../d"),
        F.concat(F.lit("?page="), page),
        F.lit("/abs/../x"),
        F.concat(F.lit("//cdn.example/"), page),
        F.concat(F.lit(" https://other.example/"), page, F.lit(" ")),
        F.lit(""),
    )
    return (
        table(spark, sf, "pages")
        .select("page_id", "url", F.posexplode(hrefs).alias("k", "href"))
        .select("page_id", "k", U.resolve("url", "href", standard=False).alias("link"))
    )


_STANDARD = """
WITH b AS (SELECT page_id, regexp_extract(url, '^(.*?://[^/?#]*)', 1) AS o,
  regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1) AS p, regexp_extract(url, '^(.*?:)//', 1) AS s FROM pages)
SELECT page_id, CAST(k AS INTEGER) AS k, link FROM (SELECT page_id, unnest(range(9)) AS k, unnest([
  o || regexp_replace(p, '[^/]*$', '') || 'p' || page_id || '.html', o || '/x', o || '/a/', o || '/b//c?d=../e',
  o || p || '?page=' || page_id, o || p || '#top', o || '/login?next=https://other.example/',
  s || '//cdn.example/' || page_id, 'mailto:a@b.example']) AS link FROM b)"""


@query("u09_resolve_standard", _STANDARD)
def resolve_standard(spark: SparkSession, sf: str) -> DataFrame:
    """Links with known targets by the URL standard."""
    page = F.col("page_id").cast("string")
    hrefs = F.array(
        F.concat(F.lit("p"), page, F.lit(".html")),
        F.lit("/abs/../x"),
        F.lit("/a/b/./.."),
        F.lit("/../b//c?d=../e"),
        F.concat(F.lit(" ?page="), page),
        F.lit("#top"),
        F.lit("/login?next=https://other.example/"),
        F.concat(F.lit("//cdn.example/"), page),
        F.lit("mailto:a@b.example"),
    )
    return (
        table(spark, sf, "pages")
        .select("page_id", "url", F.posexplode(hrefs).alias("k", "href"))
        .select("page_id", "k", U.resolve("url", "href").alias("link"))
    )


@query(
    "u20_normalised_pages",
    """
WITH v AS (SELECT page_id, unnest([url, upper(split_part(url, '://', 1)) || '://' ||
    split_part(url, '://', 2), regexp_replace(url, '^(http://[^/]+)', '\\1:80')]) AS u FROM pages),
b AS (SELECT page_id, split_part(u, '#', 1) AS u FROM v),
p AS (SELECT page_id, lower(split_part(u, '://', 1)) AS scheme,
  lower(regexp_extract(u, '://([^/?]*)', 1)) AS auth,
  rtrim(regexp_extract(u, '://[^/?]*([^?]*)', 1), '/') AS page,
  list_sort(list_filter(string_split(split_part(u, '?', 2), '&'),
    lambda x: x <> '' AND x NOT LIKE 'utm\\_%' ESCAPE '\\')) AS params FROM b),
n AS (SELECT page_id, scheme || '://' || CASE WHEN scheme = 'http' THEN regexp_replace(auth, ':80$', '')
  ELSE regexp_replace(auth, ':443$', '') END || page ||
  CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS page_url FROM p)
SELECT page_url, count(*) AS spellings, count(DISTINCT page_id) AS pages FROM n GROUP BY 1""",
)
def normalised(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("url")
    spellings = F.array(
        u,
        F.concat(F.upper(F.substring_index(u, "://", 1)), F.lit("://"), F.substring_index(u, "://", -1)),
        F.regexp_replace(u, "^(http://[^/]+)", "$1:80"),
    )
    return (
        table(spark, sf, "pages")
        .select("page_id", F.explode(spellings).alias("u"))
        .groupBy(U.normalise("u").alias("page_url"))
        .agg(F.count("*").alias("spellings"), F.countDistinct("page_id").alias("pages"))
    )


@query(
    "f05_same_domain",
    _VARIANTS
    + """
, h AS (SELECT page_id, k, lower(split_part(split_part(split_part(rest, '/', 1), '?', 1), ':', 1)) AS h
  FROM r),
b AS (SELECT *, CASE WHEN h LIKE 'www._%' THEN substr(h, 5) ELSE h END AS base FROM h)
SELECT page_id, k, (h <> '' AND base = 'ththin.example.com') AS same,
  (h <> '' AND (base = 'ththin.example.com' OR h LIKE '%.ththin.example.com')) AS same_or_sub FROM b""",
)
def same_domain(spark: SparkSession, sf: str) -> DataFrame:
    site = F.lit("WWW.ththin.example.com")
    return url_variants(spark, sf).select(
        "page_id",
        "k",
        U.same_domain("u", site).alias("same"),
        U.same_domain("u", site, subdomains=True).alias("same_or_sub"),
    )


@query(
    "u18_url_like",
    """
SELECT page_id, url, length(html) AS html_chars FROM pages
WHERE url LIKE '%.example.org/en/%' AND url NOT LIKE '%utm\\_source%' ESCAPE '\\'""",
)
def url_like(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    wanted = pages.filter(
        F.col("url").like("%.example.org/en/%") & ~F.col("url").like(r"%utm\_source%")
    )
    return wanted.select("page_id", "url", F.length("html").cast("long").alias("html_chars"))
