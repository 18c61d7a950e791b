"""Documents made from the raw tables, with known contents to extract again.

Every page covers a bounded run of keys, so pages stay short at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.sources.tables import dealt, table

ROWS_PER_PAGE = 20


def glue(*parts: str | Column) -> Column:
    """Concatenation of fixed texts (as they are) and columns."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def escaped(text: Column) -> Column:
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(mark), F.lit(entity))
    return text


def money(amount: str) -> Column:
    return F.col(amount).cast("decimal(14,2)").cast("string")


def product_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A page per part: JSON-LD, og and twitter tags, microdata and plain markup."""
    key, name = F.col("p_partkey"), F.col("p_name")
    linked = F.to_json(
        F.struct(
            F.lit("https://schema.org").alias("@context"),
            F.array(
                F.struct(
                    F.array(F.lit("http://schema.org/Product"), F.lit("Thing")).alias("@type"),
                    glue("SKU-", key).alias("sku"),
                    glue("<", name, "> & more").alias("name"),
                    F.struct(F.lit("Brand").alias("@type"), F.col("p_brand").alias("name")).alias("brand"),
                    F.struct(money("p_retailprice").alias("price"), F.lit("EUR").alias("priceCurrency")).alias("offers"),
                    F.col("p_size").alias("size"),
                    F.array(
                        F.struct(F.lit("a").alias("label"), F.col("p_size").alias("v")),
                        F.struct(F.lit("b").alias("label"), F.lit(None).cast("int").alias("v")),
                    ).alias("variants"),
                )
            ).alias("@graph"),
        )
    )
    # One product per page, so its shelf mates are stated by number.
    html = glue(
        "<!DOCTYPE html><html><head><title>", escaped(name), " &amp; co</title>"
        '<meta property="og:title" content="old"><meta property=\'og:title\' content=\'', escaped(name), "'>"
        '<meta content="product" property="og:type"><meta property="og:empty" content="">'
        '<meta name="twitter:card" content="summary"><meta name="Twitter:site" content="no">'
        '<meta name="keywords" content="', F.col("p_brand"), "&amp;", F.col("p_type"), '">'
        '<META NAME="Description" CONTENT="All about &quot;', escaped(name), '&quot;">'
        '<link rel="canonical" href="/p/', key, '?v=1">'
        '<script type="application/ld+json">', linked, "</script>"
        '<script type="application/ld+json">{broken</script></head><body>'
        '<!-- <div class="price">none</div> -->'
        '<nav><ul class="breadcrumb"><li>Home<li><a href="/b">', F.col("p_brand"), "</a><li>", F.col("p_type"), "</ul></nav>"
        '<div class="product card" id="main" data-sku="SKU-', key, '" data-json=\'{"items":[{"id":', key,
        '},{"x":0},{"id":', key + 1, '}],"n":', F.col("p_size"), "}'>"
        '<h1 class="name">  ', escaped(name), ' </h1><a class="buy link" href="/buy/', key, '"><span class="price sale">&euro;',
        money("p_retailprice"), '</span></a><p class="stock">',
        F.when(key % 3 == 0, "Sold out").when(key % 3 == 1, "In Stock").otherwise("Only 2 left"),
        '</p><p class="size">', F.col("p_size"), " x 250 ml</p></div>"
        '<div itemscope itemtype="https://schema.org/Offer"><meta itemprop="price" content="', money("p_retailprice"),
        '"><a itemprop="url" href="/o/', key, '">x</a><img itemprop="image" src="/i/', key, '.png">'
        '<span itemprop="seller">first</span><div itemscope itemtype="https://schema.org/Person">'
        '<b itemprop="seller"> Shop ', key, " </b></div></div></body></html>",
    )
    return dealt(table(spark, sf, "part")).select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice",
        glue("https://shop.example/p/", key).alias("url"), html.alias("html"),
    )


def card_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Listing pages with 20 parts each as repeated cards."""
    card = glue(
        '<div class="card" data-id="', F.col("p_partkey"), '"><h2><a href="/p/', F.col("p_partkey"), '">',
        escaped(F.col("p_name")), '</a></h2><span class="price">', money("p_retailprice"), "</span></div>",
    )
    ids = F.struct(F.col("p_partkey").alias("id"))
    paged = table(spark, sf, "part").withColumn("page", F.floor(F.col("p_partkey") / ROWS_PER_PAGE).cast("long"))
    return paged.groupBy("page").agg(
        glue(
            '<html><body><input id=jobs value="',
            escaped(F.to_json(F.array_sort(F.collect_list(ids)))),
            '"><main>',
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", card.alias("c")))), lambda r: r["c"]), ""),
            "</main></body></html>",
        ).alias("html")
    ).withColumn("url", glue("https://list.example/", F.col("page")))


def order_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with a table and a script array of 20 orders each."""
    o = table(spark, sf, "orders").withColumn("page", F.floor(F.col("o_orderkey") / ROWS_PER_PAGE).cast("long"))
    row = glue(
        "<tr><td>", F.col("o_orderkey"), "<td> ", F.col("o_orderstatus"), '<sup id="cite_ref-', F.col("o_orderkey"),
        '">[1]</sup>\n </td><td>', money("o_totalprice"), "</td><td>",
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey").cast("string")).otherwise(""), "</td></tr>",
    )
    item = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"),
            money("o_totalprice").alias("total"), (F.col("o_orderkey") % 2 == 0).alias("even"),
        )
    )
    listing = F.struct("o_orderkey", row.alias("row"), item.alias("item"))
    rows = o.groupBy("page").agg(F.array_sort(F.collect_list(listing)).alias("rows"))

    def joined(name: str, separator: str) -> Column:
        return F.array_join(F.transform("rows", lambda r: r[name]), separator)

    array = glue("[", joined("item", ","), "]")
    return rows.select(
        "page",
        glue(
            "<html><body><ul><li>one<li>two<ol><li>three</ol></ul><table class=first><tr><td>x</table>"
            "<table class='orders'><thead><tr><th>Order No</th><th>Status/Mark</th><th></th></tr></thead>",
            joined("row", ""), "</table><script>// listing\nvar orders = ", array, ";\nlet page = ", F.col("page"),
            ", kind = 'orders';\nstate = JSON.parse('", F.replace(array, F.lit('"'), F.lit("\\x22")), "');\n"
            "window.App = {page: ", F.col("page"), ", 'rows': [", joined("item", ","), ",], run() { return 1 }};\n"
            "function f() { var hidden = 1 }</script></body></html>",
        ).alias("html"),
    )


def state_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A page per customer with framework state."""
    state = F.to_json(F.struct(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")))
    return table(spark, sf, "customer").select(
        "c_custkey",
        glue(
            '<html><head><script id="__NEXT_DATA__" type="application/json"> ', state,
            " </script><script>window.__NUXT__ = {seg: '", F.col("c_mktsegment"), "'}; var other = {};</script></head></html>",
        ).alias("html"),
    )
