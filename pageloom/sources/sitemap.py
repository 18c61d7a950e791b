"""Sitemap documents as tables: entries, index children and recursion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions.columns import unpack
from pageloom.session import cut_lineage

_ENTRY = "array<struct<loc: string, lastmod: string, changefreq: string, priority: string>>"
_CHILD = "array<struct<loc: string, lastmod: string>>"

# Places where sites keep their sitemap.
COMMON_PATHS = (
    "/sitemap.xml",
    "/sitemap_index.xml",
    "/sitemap-index.xml",
    "/sitemapindex.xml",
    "/sitemap/sitemap.xml",
    "/sitemaps/sitemap.xml",
    "/sitemap1.xml",
    "/sitemap-1.xml",
    "/post-sitemap.xml",
    "/page-sitemap.xml",
    "/product-sitemap.xml",
    "/category-sitemap.xml",
    "/wp-sitemap.xml",
)


def _parsed(xml: Column, element: str, kind: str) -> Column:
    return F.from_xml(xml, f"{element} {kind}")[element]


def entries(documents: DataFrame) -> DataFrame:
    """URL entries of ``(sitemap_url, xml)``; entries without an address are dropped."""
    is_set = ~F.contains(F.col("xml"), F.lit("<sitemapindex"))
    rows = unpack(documents.filter(is_set), ["sitemap_url"], _parsed(F.col("xml"), "url", _ENTRY), "i", "e")
    return rows.select(
        "sitemap_url",
        F.trim("e.loc").alias("url"),
        F.col("e.lastmod").alias("lastmod"),
        F.col("e.changefreq").alias("changefreq"),
        F.trim("e.priority").try_cast("double").alias("priority"),
    ).filter("url <> ''")


def children(documents: DataFrame) -> DataFrame:
    """Child sitemaps named by index documents."""
    is_index = F.contains(F.col("xml"), F.lit("<sitemapindex"))
    rows = unpack(documents.filter(is_index), ["sitemap_url"], _parsed(F.col("xml"), "sitemap", _CHILD), "i", "e")
    return rows.select(
        F.col("sitemap_url").alias("parent"), F.trim("e.loc").alias("child"), F.col("e.lastmod").alias("lastmod")
    ).filter("child <> ''")


def read_sitemaps(
    start: DataFrame, documents: DataFrame, recursive: bool = True, max_depth: int = 5
) -> DataFrame:
    """Entries of the start sitemaps and, if asked, of the children below them.

    Each sitemap is read once at its least depth, so cycles end by themselves.
    """
    seen = start.select("sitemap_url").distinct()
    newest = seen
    if recursive:
        below = cut_lineage(children(documents).select("parent", "child").distinct())
        for _ in range(max_depth):
            newest = cut_lineage(
                below.join(newest.select(F.col("sitemap_url").alias("parent")), "parent", "left_semi")
                .select(F.col("child").alias("sitemap_url"))
                .distinct()
                .join(seen, "sitemap_url", "left_anti")
            )
            if newest.isEmpty():
                break
            seen = seen.unionByName(newest)
    return entries(documents.join(seen, "sitemap_url", "left_semi"))


def discovered_start(start: DataFrame, robots_sitemaps: DataFrame) -> DataFrame:
    """Sitemaps named by the robots file of a start URL's host, else the start URL."""
    from pageloom.functions import url as U

    keyed = start.withColumn("host", U.host("sitemap_url"))
    named = robots_sitemaps.select("host", F.col("sitemap_url").alias("named"))
    return keyed.join(named, "host", "left").select(
        F.coalesce("named", "sitemap_url").alias("sitemap_url")
    ).distinct()


def candidate_locations(hosts: DataFrame) -> DataFrame:
    """The common sitemap addresses of every host."""
    path = F.explode(F.array(*[F.lit(p) for p in COMMON_PATHS]))
    return hosts.select("host", path.alias("path")).select(
        "host", F.concat(F.lit("https://"), F.col("host"), F.col("path")).alias("sitemap_url")
    )


def gzipped(content: Column) -> Column:
    """Whether binary content carries the gzip mark."""
    return F.hex(F.substring(content, 1, 2)) == "1F8B"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Sitemap files as ``(sitemap_url, xml)``; names that end in ``.gz`` are inflated on reading."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("sitemap_url"), F.col("value").alias("xml")
    )


def compressed_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of a folder with their size and whether their content is gzipped."""
    return spark.read.format("binaryFile").load(path).select("path", "length", gzipped(F.col("content")).alias("gzipped"))
