"""Headline timings: one JSON line, seconds per query after one warm-up run."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions import dom as D
from pageloom.functions import script_vars as S
from pageloom.functions import tags as T
from pageloom.operators import frontier as FR
from pageloom.plans import all_queries
from pageloom.plans import documents as DOC
from pageloom.plans.crawl_queries import graph_seeds, order_graph
from pageloom.session import get_spark
from pageloom.sources.tables import page_table, table

COPIES = 100


def copied_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The pages a hundred times, so that the work outweighs the start of the job."""
    pages = page_table(spark, sf)
    copies = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("copy")
    return pages.select("page_id", "url", "html", copies).withColumn("page_id", F.col("page_id") * COPIES + F.col("copy"))


def links(spark: SparkSession, sf: str) -> DataFrame:
    return T.links(copied_pages(spark, sf), ["page_id", "url"])


def distinct_links(spark: SparkSession, sf: str) -> DataFrame:
    return T.distinct_links(copied_pages(spark, sf), ["page_id"], base="url")


def dense_links(spark: SparkSession, sf: str) -> DataFrame:
    """A hundred links (3 KB) on each of 10,000 documents named after orders."""
    orders = table(spark, sf, "orders").filter(F.col("o_orderkey") < 10_000).repartition(spark.sparkContext.defaultParallelism)
    one = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda i: F.concat(F.lit('<a href="/p/'), F.col("o_orderkey").cast("string"), F.lit("/"), i.cast("string"), F.lit('">link</a>')),
    )
    pages = orders.select(
        F.col("o_orderkey").alias("page_id"), F.lit("https://dense.example/").alias("url"), F.array_join(one, "\n").alias("html")
    )
    return T.links(pages, ["page_id"])


def tag_bundle(spark: SparkSession, sf: str) -> DataFrame:
    return DOC.product_pages(spark, sf).select(
        "p_partkey",
        S.jsonld("html").alias("jsonld"),
        T.open_graph("html").alias("og"),
        F.size(T.all_tags("html", T.LINK_TAG)).alias("links"),
    )


def node_table(spark: SparkSession, sf: str) -> DataFrame:
    pages = page_table(spark, sf)
    return D.node_table(pages, ["page_id"]).groupBy("tag").agg(F.count("*").alias("n"))


def css_first(spark: SparkSession, sf: str) -> DataFrame:
    pages = page_table(spark, sf)
    return pages.withColumn("dom", D.parse("html")).select("page_id", D.access("html", "article > h1", dom="dom").alias("h1"))


def frontier(spark: SparkSession, sf: str) -> DataFrame:
    return FR.follow(order_graph(spark, sf), graph_seeds(spark, sf), 3)


NAMED = (
    "flagship_links_per_host",
    "x24_x25_specs",
    "x19_article",
    "t01_t06_table_cells",
    "k08_merge_snapshot",
    "m07_outcome_counts",
    "m08_limited_merge",
    "r04_longest_match_verdict",
    "f09_f18_earliest_offsets",
    "f14_domain_blocks",
    "s06_s07_sitemap_entries",
    "price_history_lag",
    "u09_resolve",
)


def timed(spark: SparkSession, build: Callable[[SparkSession, str], DataFrame], sf: str) -> float:
    seconds = 0.0
    for _ in range(2):
        start = time.perf_counter()
        build(spark, sf).write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - start
    return round(seconds, 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    own = {
        "links_x100": links,
        "dense_links_1m": dense_links,
        "distinct_links_x100": distinct_links,
        "tag_bundle": tag_bundle,
        "node_table": node_table,
        "css_first": css_first,
        "frontier_depth3": frontier,
    }
    known = all_queries()
    seconds = {name: timed(spark, build, sf) for name, build in own.items()}
    seconds |= {name: timed(spark, known[name].build, sf) for name in NAMED}
    found = links(spark, sf).count()
    pages = table(spark, sf, "pages").count()
    rates = {
        "links_per_sec": round(found / seconds["links_x100"]),
        "dense_links_per_sec": round(dense_links(spark, sf).count() / seconds["dense_links_1m"]),
        "distinct_links_per_sec": round(found / seconds["distinct_links_x100"]),
        "link_pages_per_sec": round(pages * COPIES / seconds["links_x100"]),
        "node_pages_per_sec": round(pages / seconds["node_table"]),
        "bundle_pages_per_sec": round(table(spark, sf, "part").count() / seconds["tag_bundle"]),
        "merge_rows_per_sec": round(table(spark, sf, "orders").count() / seconds["k08_merge_snapshot"]),
    }
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rates": rates,
                "sf": sf,
            }
        )
    )


if __name__ == "__main__":
    main()
