"""Page scans: seeds joined to a response store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions import response as R
from pageloom.functions import tags as T
from pageloom.functions.response import size_limited
from pageloom.operators.frontier import first_results
from pageloom.operators.running import join_hot
from pageloom.operators.snapshot import fresh_entries, unseen
from pageloom.session import cut_lineage

NOT_CAPTURED = "not_captured"


def seed_urls(seeds: DataFrame) -> DataFrame:
    """First column of any relation as the URL list, without NULLs."""
    return seeds.select(F.col(seeds.columns[0]).alias("url")).dropna()


# Columns every store has; further ones, such as redirects, are passed on.
PAGE_COLUMNS = ("url", "status", "content_type", "body", "error", "response_time_ms")


def _page_columns(joined: DataFrame, keep: list[str], store: DataFrame) -> DataFrame:
    problem = F.when(F.col("_hit").isNull(), NOT_CAPTURED).otherwise(F.nullif(F.col("error"), F.lit("")))
    extra = [c for c in store.columns if c not in PAGE_COLUMNS]
    return joined.select(
        "url", *keep, "status", "content_type", "body", problem.alias("error"), "response_time_ms", *extra
    )


def scan(seeds: DataFrame, store: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """One page row per distinct seed URL at depth 1; known URLs are skipped."""
    wanted = seeds.select("url").filter("url <> ''").distinct()
    if state is not None:
        wanted = unseen(wanted, state)
    found = wanted.join(store.withColumn("_hit", F.lit(True)), "url", "left")
    return _page_columns(found, [], store).withColumn("depth", F.lit(1))


def lookup_each(rows: DataFrame, store: DataFrame, **sizes: int) -> DataFrame:
    """One page row per input row: NULL URLs give an error row, empty ones none.

    Rows without a URL do not take part in the join.  ``sizes`` (``hot_rows``, ``salts``)
    spread URLs asked for very often by hand, see :func:`running.lookup`.
    """
    keep = [c for c in rows.columns if c != "url"]
    found = join_hot(rows.filter("url <> ''"), store.withColumn("_hit", F.lit(True)), "url", **sizes)
    pages = _page_columns(found, keep, store)
    missing = rows.filter("url is null").withColumn("error", F.lit("NULL URL"))
    return pages.unionByName(missing, allowMissingColumns=True)


def crawl(
    seeds: DataFrame,
    store: DataFrame,
    max_depth: int = 1,
    selector: str | None = None,
    max_results: int | None = None,
    state: DataFrame | None = None,
    skip_nofollow: bool = False,
    robots: DataFrame | None = None,
    user_agent: str = "pageloom",
    as_of: Column | None = None,
    ttl_hours: int = 24,
    max_bytes: int | None = None,
) -> DataFrame:
    """Page rows of the seeds and of what they link to, with the depth of each URL.

    Links are followed from successful pages with a body only, without a limit to
    their host; ``selector`` picks the link elements, otherwise every ``a`` counts.
    URLs of ``state`` are not looked up, and links do not lead through them; a seed is
    a place to start from even if it is known.

    Three rules hold at every step, so none of them is led through: a URL that ``robots``
    (host, body) forbid ``user_agent`` has status -1 and the error ``robots_disallowed``; with ``as_of``
    an entry of the store whose ``cached_at`` is older than ``ttl_hours`` counts as not captured; a body of
    more than ``max_bytes`` is left out with the error ``content_too_large``.

    Each depth joins the store with the new URLs only, ahead of reading links: where these
    are few, that is a broadcast and no page but theirs is parsed or moved.
    """
    from pageloom.operators.extract import selected_links
    from pageloom.operators.robots import with_verdict

    usable = store if as_of is None else fresh_entries(store, as_of, ttl_hours)
    if max_bytes is not None:
        limited = size_limited("body", max_bytes)
        usable = usable.withColumn("error", F.coalesce(limited["error"], "error")).withColumn("body", limited["body"])
    known = None if state is None else state.select("url")
    readable = usable.filter(R.is_success("status") & (F.length("body") > 0)).select("url", "body")

    def judged(urls: DataFrame) -> DataFrame:
        if robots is None:
            return urls.withColumn("allowed", F.lit(True))
        return with_verdict(urls, robots, user_agent).select(*urls.columns, "allowed")

    newest = judged(seeds.select("url").filter("url <> ''").distinct().withColumn("depth", F.lit(1)))
    if max_depth > 1:
        newest = cut_lineage(newest)
    reached = newest
    for depth in range(2, max_depth + 1):
        here = readable.join(newest.filter("allowed").select("url"), "url", "left_semi")
        links = T.links(here, ["url"], html="body") if selector is None else selected_links(here, ["url"], selector, html="body")
        if skip_nofollow:
            links = links.filter(~F.col("nofollow"))
        found = links.select(F.col("link").alias("url")).distinct().join(reached.select("url"), "url", "left_anti")
        if known is not None:
            found = unseen(found, known)
        newest = judged(found.withColumn("depth", F.lit(depth)))
        if depth < max_depth:
            newest = cut_lineage(newest)
            if newest.isEmpty():
                break
        reached = reached.unionByName(newest)
    if known is not None:
        reached = unseen(reached, known)
    if max_results is not None:
        reached = first_results(reached, max_results)
    joined = reached.filter("allowed").join(usable.withColumn("_hit", F.lit(True)), "url", "left")
    rows = _page_columns(joined, ["depth"], store)
    if robots is None:
        return rows
    refused = reached.filter("not allowed").select("url", "depth", F.lit(-1).alias("status"), F.lit("robots_disallowed").alias("error"))
    return rows.unionByName(refused, allowMissingColumns=True)
