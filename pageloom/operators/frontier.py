"""Link following over an edge table, one join per depth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.session import cut_lineage


def follow(
    edges: DataFrame,
    seeds: DataFrame,
    max_depth: int,
    expandable: DataFrame | None = None,
    skip_nofollow: bool = False,
) -> DataFrame:
    """Least depth of every URL reachable from the seeds (seeds have depth 1).

    ``edges`` has ``src_url``, ``dst_url`` and optionally ``nofollow``;
    ``expandable`` lists the URLs whose links may be followed.  Each depth is one
    join against the new URLs only, then an anti-join against those seen before.
    """
    if skip_nofollow:
        edges = edges.filter(~F.col("nofollow"))
    edges = edges.select("src_url", "dst_url")
    if expandable is not None:
        edges = edges.join(expandable.select(F.col("url").alias("src_url")), "src_url", "left_semi")
    if max_depth > 2:
        # Laid out by source once, so that no depth shuffles the edges again.
        edges = cut_lineage(edges.repartition("src_url"))
    seen = seeds.select("url").filter("url <> ''").distinct().withColumn("depth", F.lit(1))
    newest = seen
    for depth in range(2, max_depth + 1):
        reached = (
            edges.join(newest.select(F.col("url").alias("src_url")), "src_url", "left_semi")
            .select(F.col("dst_url").alias("url"))
            .distinct()
            .join(seen.select("url"), "url", "left_anti")
            .withColumn("depth", F.lit(depth))
        )
        if depth < max_depth:
            reached = cut_lineage(reached)
            if reached.isEmpty():
                break
        seen = seen.unionByName(reached)
        newest = reached
    return seen


def first_results(pages: DataFrame, limit: int, order: Sequence[str] = ("depth", "url")) -> DataFrame:
    """At most ``limit`` pages in crawl order."""
    return pages.orderBy(*order).limit(limit)


def collapse_canonical(pages: DataFrame, url: str = "url", canonical: str = "canonical") -> DataFrame:
    """One row per canonical URL: the smallest page URL and how many pages share it."""
    shared = F.coalesce(F.nullif(F.col(canonical), F.lit("")), F.col(url))
    return pages.groupBy(shared.alias("page_url")).agg(
        F.min(url).alias("first_url"), F.count("*").alias("pages")
    )


# Hours after which a sitemap change frequency calls for a new visit.
CHANGE_HOURS = {
    "always": 0,
    "hourly": 1,
    "daily": 24,
    "weekly": 168,
    "monthly": 720,
    "yearly": 8760,
    "never": 87600,
}
DEFAULT_CHANGE_HOURS = 168


def change_hours(changefreq: Column) -> Column:
    hours = F.lit(DEFAULT_CHANGE_HOURS)
    for word, value in CHANGE_HOURS.items():
        hours = F.when(F.lower(changefreq) == word, value).otherwise(hours)
    return hours


def is_stale(lastmod: Column, changefreq: Column, crawled_at: Column, as_of: Column) -> Column:
    """Whether a known URL is due: changed since the visit, or visited too long ago."""
    age = F.unix_timestamp(as_of.cast("timestamp")) - F.unix_timestamp(crawled_at.cast("timestamp"))
    newer = F.coalesce(lastmod > crawled_at, F.lit(False))
    return newer | (age > change_hours(changefreq) * 3600)


def visit_plan(entries: DataFrame, state: DataFrame, as_of: Column) -> DataFrame:
    """URLs to visit: new ones as inserts (kind 1), then stale ones as updates (kind 2)."""
    joined = entries.join(state.select("url", "crawled_at"), "url", "left")
    due = is_stale(F.col("lastmod"), F.col("changefreq"), F.col("crawled_at"), as_of)
    kind = F.when(F.col("crawled_at").isNull(), 1).when(due, 2)
    return joined.withColumn("kind", kind).filter("kind is not null")
