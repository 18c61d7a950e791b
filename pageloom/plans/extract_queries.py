"""Field extraction from documents with known contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions import article as A
from pageloom.functions import dom as D
from pageloom.functions import json_path as J
from pageloom.functions import script_vars as S
from pageloom.functions import tags as T
from pageloom.functions.columns import unpack
from pageloom.functions.htmlpath import htmlpath
from pageloom.operators import extract as E
from pageloom.plans import documents as DOC
from pageloom.plans.registry import query
from pageloom.sources import html_table as H
from pageloom.sources.tables import page_table, table

_MONEY = "CAST(CAST(p_retailprice AS DECIMAL(14,2)) AS VARCHAR)"


def _parsed(pages: DataFrame) -> DataFrame:
    return pages.withColumn("dom", D.parse("html"))


# --- element tree -------------------------------------------------------------


@query(
    "x00_node_table",
    """
WITH b AS (SELECT page_id, regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'),
  '<script[^>]*>.*?</script', '<script></script', 'gs') AS html FROM pages),
t AS (SELECT page_id, unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)[^>]*>', 1)) AS tag FROM b)
SELECT page_id, lower(tag) AS tag, count(*) AS nodes FROM t GROUP BY 1, 2""",
)
def node_table(spark: SparkSession, sf: str) -> DataFrame:
    nodes = D.node_table(page_table(spark, sf), ["page_id"])
    return nodes.groupBy("page_id", "tag").agg(F.count("*").alias("nodes"))


@query(
    "x00_article_children",
    """
SELECT page_id, 'h1' AS tag, 1::BIGINT AS nodes FROM pages
UNION ALL SELECT page_id, 'p', len(regexp_extract_all(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '<p>'))
FROM pages""",
)
def article_children(spark: SparkSession, sf: str) -> DataFrame:
    """Structural join on the node table: children of article elements."""
    nodes = D.node_table(page_table(spark, sf), ["page_id"]).select("page_id", "id", "parent", "tag")
    parents = nodes.filter("tag = 'article'").select("page_id", F.col("id").alias("parent"))
    found = nodes.filter("tag in ('h1', 'p')").join(parents, ["page_id", "parent"])
    return found.groupBy("page_id", "tag").agg(F.count("*").alias("nodes"))


@query(
    "x01_css_first",
    f"""
SELECT p_partkey, p_name AS name, 'SKU-' || p_partkey AS sku, '€' || {_MONEY} AS price, p_type AS last_crumb,
  CAST(NULL AS VARCHAR) AS none FROM part""",
)
def css_first(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(DOC.product_pages(spark, sf)).select(
        "p_partkey",
        D.access("html", "h1.name", dom="dom").alias("name"),
        D.access("html", "#main[data-sku^='SKU-']", "attr:data-sku", "dom").alias("sku"),
        D.access("html", "div.card > a .price", dom="dom").alias("price"),
        D.access("html", ".breadcrumb li:last-child", dom="dom").alias("last_crumb"),
        D.access("html", "div.absent", dom="dom").alias("none"),
    )


@query(
    "x02_parent_of_match",
    "SELECT p_partkey, '/buy/' || p_partkey AS href, 'SKU-' || p_partkey AS sku FROM part",
)
def parent_of_match(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(DOC.product_pages(spark, sf)).select(
        "p_partkey",
        D.access("html", "span.price", "parent.attr:href", "dom").alias("href"),
        D.access("html", "h1", "parent.attr:data-sku", "dom").alias("sku"),
    )


@query(
    "x03_child_of_match",
    "SELECT p_partkey, 'Home' AS first, p_brand AS second, CAST(NULL AS VARCHAR) AS ninth FROM part",
)
def child_of_match(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(DOC.product_pages(spark, sf)).select(
        "p_partkey",
        D.access("html", "ul.breadcrumb", "children.0.text", "dom").alias("first"),
        D.access("html", "ul.breadcrumb", "children.1.text", "dom").alias("second"),
        D.access("html", "ul.breadcrumb", "children.9.text", "dom").alias("ninth"),
    )


@query(
    "x04_element_struct",
    f"""
SELECT p_partkey, '€' || {_MONEY} AS text, '<span class="price sale">&euro;' || {_MONEY} || '</span>' AS inner_html,
  'buy link' AS cls, '/buy/' || p_partkey AS href, true AS missing_is_null FROM part""",
)
def element_struct(spark: SparkSession, sf: str) -> DataFrame:
    picked = _parsed(DOC.product_pages(spark, sf)).select(
        "p_partkey",
        D.element("html", "a.buy", "dom").alias("e"),
        D.element("html", "a.sell", "dom").isNull().alias("missing_is_null"),
    )
    return picked.select(
        "p_partkey",
        F.col("e.text").alias("text"),
        F.col("e.html").alias("inner_html"),
        F.col("e.attr")["class"].alias("cls"),
        F.col("e.attr")["href"].alias("href"),
        "missing_is_null",
    )


@query("x05_element_attribute", "SELECT p_partkey, 'SKU-' || p_partkey AS sku, '' AS missing FROM part")
def element_attribute(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(DOC.product_pages(spark, sf)).select(
        "p_partkey",
        D.element_attribute("html", "[data-sku]", "data-sku", "dom").alias("sku"),
        D.element_attribute("html", "h1", "data-sku", "dom").alias("missing"),
    )


@query(
    "x06_css_select",
    f"""
SELECT p_partkey, '<span class="price sale">&euro;' || {_MONEY} || '</span>' AS outer_html, p_size || ' x 250 ml' AS size,
  '' AS missing FROM part""",
)
def css_select(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(DOC.product_pages(spark, sf)).select(
        "p_partkey",
        D.css_select("html", "a.buy > .price, p.size", "html", "dom").alias("outer_html"),
        D.css_select("html", "p.size", dom="dom").alias("size"),
        D.css_select("html", "p.nothing", dom="dom").alias("missing"),
    )


@query(
    "x07_all_matches",
    """
SELECT CAST(floor(p_partkey / 20) AS BIGINT) AS page, p_name AS name, count(*) AS cards FROM part GROUP BY 1, 2""",
)
def all_matches(spark: SparkSession, sf: str) -> DataFrame:
    names = unpack(_parsed(DOC.card_pages(spark, sf)), ["page"], D.all_texts("html", "div.card h2 a", "dom"), "i", "name")
    return names.groupBy("page", "name").agg(F.count("*").alias("cards"))


@query(
    "x08_htmlpath",
    f"""
SELECT p_partkey, '"SKU-' || p_partkey || '"' AS attr, '"<' || p_name || '> & more"' AS in_json,
  '[' || p_partkey || ',' || (p_partkey + 1) || ']' AS each_id, CAST(p_size AS VARCHAR) AS number,
  'null' AS missing, '"' || p_name || '"' AS text FROM part""",
)
def htmlpath_values(spark: SparkSession, sf: str) -> DataFrame:
    paths = {
        "attr": "div.card@data-sku",
        "in_json": "script[type='application/ld+json']@text.@graph[0].name",
        "each_id": "div.card@data-json",
        "number": "div.card@data-json.n",
        "missing": "div.card@data-json.absent",
        "text": "h1@text",
    }
    paths["in_json"] = "#ld@text"
    pages = DOC.product_pages(spark, sf)
    items = F.regexp_extract("html", r"data-json='\{\"items\":(\[.*?\])", 1)
    first = F.regexp_extract("html", r"(?s)<script type=\"application/ld\+json\">\{.*?\"@graph\":\[(.*?)\]\}</script>", 1)
    parsed = _parsed(
        pages.withColumn(
            "html",
            DOC.glue("<p id=items data-v='", items, "'></p><script id=ld>", first, "</script>", F.col("html")),
        )
    )
    paths["each_id"] = "#items@data-v[*].id"
    paths["in_json"] = "#ld@text.name"
    return parsed.select("p_partkey", *[htmlpath("html", p, "dom").alias(n) for n, p in paths.items()])


@query(
    "x09_htmlpath_variable",
    """
SELECT CAST(floor(o_orderkey / 20) AS BIGINT) AS page, '[' || string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey)
  || ']' AS ids, CAST(min(o_orderkey) AS VARCHAR) AS first_id, '"orders"' AS kind FROM orders GROUP BY 1""",
)
def htmlpath_variable(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(DOC.order_pages(spark, sf)).select(
        "page",
        htmlpath("html", "@$orders[*].id", "dom").alias("ids"),
        htmlpath("html", "script@$state[0].id", "dom").alias("first_id"),
        htmlpath("html", "@$kind", "dom").alias("kind"),
    )


# --- structured data ----------------------------------------------------------


@query(
    "x10_x12_jsonld",
    f"""
SELECT p_partkey, '["Product","Thing"]' AS types, 'SKU-' || p_partkey AS sku, '<' || p_name || '> & more' AS name,
  p_brand AS brand, {_MONEY} AS price, p_size AS size FROM part""",
)
def jsonld(spark: SparkSession, sf: str) -> DataFrame:
    held = DOC.product_pages(spark, sf).select("p_partkey", S.jsonld("html").alias("m"))
    product = F.col("m")["Product"]
    return held.select(
        "p_partkey",
        F.to_json(F.map_keys("m")).alias("types"),
        F.get_json_object(product, "$[0].sku").alias("sku"),
        F.get_json_object(product, "$[0].name").alias("name"),
        F.get_json_object(product, "$[0].brand.name").alias("brand"),
        F.get_json_object(product, "$[0].offers.price").alias("price"),
        F.get_json_object(product, "$[0].size").cast("int").alias("size"),
    )


@query(
    "x11_jsonld_first_type",
    "SELECT p_partkey, '[\"Product\"]' AS types, 'SKU-' || p_partkey AS sku FROM part",
)
def jsonld_first_type(spark: SparkSession, sf: str) -> DataFrame:
    loose = F.regexp_replace("html", r"\]\}</script>", "],} // end\n</script>")
    held = DOC.product_pages(spark, sf).select("p_partkey", S.first_type_jsonld(loose).alias("m"))
    return held.select(
        "p_partkey",
        F.to_json(F.map_keys("m")).alias("types"),
        F.get_json_object(F.col("m")["Product"], "$.sku").alias("sku"),
    )


@query(
    "x13_microdata",
    f"""
SELECT p_partkey, '{{"image":"/i/' || p_partkey || '.png","price":"' || {_MONEY} || '","seller":"Shop ' || p_partkey
  || '","url":"/o/' || p_partkey || '"}}' AS offer, '{{"seller":"Shop ' || p_partkey || '"}}' AS person FROM part""",
)
def microdata(spark: SparkSession, sf: str) -> DataFrame:
    held = _parsed(DOC.product_pages(spark, sf)).select("p_partkey", S.microdata("dom").alias("m"))
    return held.select(
        "p_partkey",
        F.regexp_extract(F.col("m")["Offer"], r"^\[(.*)\]$", 1).alias("offer"),
        F.regexp_extract(F.col("m")["Person"], r"^\[(.*)\]$", 1).alias("person"),
    )


@query(
    "x14_schema_map",
    """
SELECT 'Offer' AS type, count(*) AS pages, count(*) AS items FROM part
UNION ALL SELECT 'Person', count(*), count(*) FROM part UNION ALL SELECT 'Product', count(*), count(*) FROM part
UNION ALL SELECT 'Thing', count(*), count(*) FROM part""",
)
def schema_map(spark: SparkSession, sf: str) -> DataFrame:
    held = _parsed(DOC.product_pages(spark, sf)).select(F.explode_outer(S.schema_map("html", "dom")).alias("type", "json"))
    return held.groupBy("type").agg(
        F.count("*").alias("pages"), F.sum(F.json_array_length("json")).alias("items")
    )


@query(
    "x15_open_graph",
    "SELECT p_partkey, p_name AS title, 'product' AS kind, '' AS blank, 3 AS properties FROM part",
)
def open_graph(spark: SparkSession, sf: str) -> DataFrame:
    held = DOC.product_pages(spark, sf).select("p_partkey", T.open_graph("html").alias("og"))
    return held.select(
        "p_partkey",
        F.col("og")["title"].alias("title"),
        F.col("og")["type"].alias("kind"),
        F.col("og")["empty"].alias("blank"),
        F.size("og").alias("properties"),
    )


@query(
    "x15b_twitter_card",
    "SELECT p_partkey, '{\"card\":\"summary\"}' AS twitter FROM part",
)
def twitter_card(spark: SparkSession, sf: str) -> DataFrame:
    return DOC.product_pages(spark, sf).select("p_partkey", F.to_json(T.twitter_card("html")).alias("twitter"))


@query(
    "x15c_meta_tags",
    """
SELECT p_partkey, '["Description","Twitter:site","keywords","twitter:card"]' AS names, p_brand || '&' || p_type AS keywords
FROM part""",
)
def meta_tags(spark: SparkSession, sf: str) -> DataFrame:
    held = DOC.product_pages(spark, sf).select("p_partkey", T.meta_tags("html").alias("m"))
    return held.select(
        "p_partkey", F.to_json(F.map_keys("m")).alias("names"), F.col("m")["keywords"].alias("keywords")
    )


@query(
    "x15d_meta_digest",
    """
SELECT p_partkey, 'All about "' || p_name || '"' AS description, p_brand || '&' || p_type AS keywords,
  CAST(NULL AS VARCHAR) AS author, 'https://shop.example/p/' || p_partkey || '?v=1' AS canonical FROM part""",
)
def meta_digest(spark: SparkSession, sf: str) -> DataFrame:
    held = DOC.product_pages(spark, sf).select("p_partkey", T.meta_digest("html", "url").alias("m"))
    return held.select("p_partkey", "m.description", "m.keywords", "m.author", "m.canonical")


@query(
    "x16_script_variables",
    """
SELECT CAST(floor(o_orderkey / 20) AS BIGINT) AS page, '["kind","orders","page","state"]' AS names,
  CAST(count(*) AS INTEGER) AS orders, CAST(sum(o_orderkey) AS BIGINT) AS key_sum, '"orders"' AS kind FROM orders GROUP BY 1""",
)
def script_variables(spark: SparkSession, sf: str) -> DataFrame:
    held = DOC.order_pages(spark, sf).select("page", S.variables("html").alias("v"))
    ids = F.from_json(F.col("v")["state"], "array<struct<id: long>>")
    return held.select(
        "page",
        F.to_json(F.map_keys("v")).alias("names"),
        F.json_array_length(F.col("v")["orders"]).alias("orders"),
        F.aggregate(ids, F.lit(0).cast("long"), lambda n, i: n + i["id"]).alias("key_sum"),
        F.col("v")["kind"].alias("kind"),
    )


@query(
    "x17_state_variables",
    """
SELECT CAST(floor(o_orderkey / 20) AS BIGINT) AS page, '["App","orders","state"]' AS names,
  CAST(floor(o_orderkey / 20) AS BIGINT)::VARCHAR AS app_page, CAST(count(*) AS INTEGER) AS app_rows FROM orders GROUP BY 1""",
)
def state_variables(spark: SparkSession, sf: str) -> DataFrame:
    held = DOC.order_pages(spark, sf).select("page", S.state_variables("html").alias("v"))
    return held.select(
        "page",
        F.to_json(F.map_keys("v")).alias("names"),
        F.get_json_object(F.col("v")["App"], "$.page").alias("app_page"),
        F.json_array_length(F.get_json_object(F.col("v")["App"], "$.rows")).alias("app_rows"),
    )


@query(
    "x18_hydration",
    """
SELECT c_custkey, '["__NEXT_DATA__","__NUXT__"]' AS names, c_name AS name, c_mktsegment AS segment FROM customer""",
)
def hydration(spark: SparkSession, sf: str) -> DataFrame:
    held = DOC.state_pages(spark, sf).select("c_custkey", S.hydration("html").alias("h"))
    return held.select(
        "c_custkey",
        F.to_json(F.map_keys("h")).alias("names"),
        F.get_json_object(F.col("h")["__NEXT_DATA__"], "$.name").alias("name"),
        F.get_json_object(F.col("h")["__NUXT__"], "$.seg").alias("segment"),
    )


@query(
    "x19_article",
    """
SELECT page_id, regexp_extract(html, '<article>(.*?)</article>', 1, 's') AS content FROM pages""",
)
def article(spark: SparkSession, sf: str) -> DataFrame:
    held = _parsed(page_table(spark, sf)).select("page_id", A.article("html", "dom").alias("a"))
    return held.select("page_id", "a.content")


@query(
    "x19_article_text",
    """
WITH a AS (SELECT page_id, regexp_extract(html, '<article>(.*?)</article>', 1, 's') AS c FROM pages),
t AS (SELECT page_id, replace(replace(replace(replace(replace(regexp_replace(c, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'),
  '&quot;', '"'), '&#x27;', ''''), '&amp;', '&') AS t FROM a),
s AS (SELECT page_id, trim(regexp_replace(t, '\\s+', ' ', 'g')) AS t FROM t)
SELECT page_id, strlen(t) AS length, t[1:200] || CASE WHEN strlen(t) > 200 THEN '...' ELSE '' END AS excerpt FROM s""",
)
def article_text(spark: SparkSession, sf: str) -> DataFrame:
    held = _parsed(page_table(spark, sf)).select("page_id", A.article("html", "dom").alias("a"))
    return held.select("page_id", "a.length", "a.excerpt")


@query(
    "x20_discover",
    """
SELECT page_id, '{"js_vars":{"t":"</p>"}}' AS report FROM pages""",
)
def discover(spark: SparkSession, sf: str) -> DataFrame:
    return page_table(spark, sf).select("page_id", E.discover("html").alias("report"))


@query(
    "x20b_discovery_report",
    """
SELECT p_partkey, 'jsonld_type' AS section, unnest(['Product', 'Thing']) AS name, 1::BIGINT AS n FROM part
UNION ALL SELECT p_partkey, 'opengraph', unnest(['title', 'type', 'empty']), 1 FROM part
UNION ALL SELECT p_partkey, 'data_attribute', unnest(['sku', 'json']), 1 FROM part""",
)
def discovery_report(spark: SparkSession, sf: str) -> DataFrame:
    return E.discovery_report(DOC.product_pages(spark, sf), "p_partkey")


@query(
    "x21_page_struct",
    """
SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '{"t":"</p>"}' END AS js, CAST(NULL AS VARCHAR) AS opengraph,
  0 AS types, page_id % 2 = 0 AS has_article, length(html) AS document_chars FROM pages""",
)
def page_struct(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("page_id") % 2 == 0, "text/html").otherwise("image/png")
    parsed = _parsed(page_table(spark, sf)).withColumn("kind", kind)
    held = parsed.select("page_id", E.page_struct("html", "kind", "dom").alias("h"))
    return held.select(
        "page_id",
        "h.js",
        "h.opengraph",
        F.size("h.schema").alias("types"),
        F.col("h.readability").isNotNull().alias("has_article"),
        F.length("h.document").cast("long").alias("document_chars"),
    )


@query(
    "x22_bundle",
    """
SELECT p_partkey, '{"card":"summary"}' IS NOT NULL AS has_og, 'SKU-' || p_partkey AS sku,
  'https://shop.example/p/' || p_partkey || '?v=1' AS canonical FROM part""",
)
def bundle(spark: SparkSession, sf: str) -> DataFrame:
    picked = DOC.product_pages(spark, sf).select(
        "p_partkey", *E.bundle("html", "url", ["jsonld", "opengraph", "meta"])
    )
    return picked.select(
        "p_partkey",
        (F.get_json_object("opengraph", "$.type") == "product").alias("has_og"),
        F.get_json_object("jsonld", "$.Product.sku").alias("sku"),
        F.get_json_object("meta", "$.canonical").alias("canonical"),
    )


# --- specs --------------------------------------------------------------------


@query(
    "x24_x25_specs",
    f"""
SELECT p_partkey, '<' || p_name || '> & more' AS name, {_MONEY} AS price, p_name AS og, p_brand || '&' || p_type AS meta,
  'SKU-' || p_partkey AS sku, {_MONEY} AS offer, 'Shop ' || p_partkey AS seller, '{{"@type":"Brand","name":"' || p_brand || '"}}'
  AS brand_json FROM part""",
)
def specs(spark: SparkSession, sf: str) -> DataFrame:
    wanted = [
        E.Spec("name", "jsonld", "Product.name"),
        E.Spec("price", "jsonld", "Product.offers.price"),
        E.Spec("og", "og", "title"),
        E.Spec("meta", "meta", "keywords"),
        E.css("sku", "div.none::text", alternatives=(E.Spec("", "og", "sku"), E.css("", "[data-sku]::attr(data-sku)"))),
        E.Spec("offer", "microdata", "Offer.price"),
        E.Spec("seller", "jsonld", "Product.seller", alternatives=(E.Spec("", "microdata", "Offer.seller"),)),
        E.Spec("brand_json", "jsonld", "Product.brand", as_text=False),
    ]
    return E.extract(DOC.product_pages(spark, sf), wanted, ["p_partkey"])


@query(
    "x26_x28_json_cast",
    """
SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS first_id, CAST(p_size AS VARCHAR) AS n, '"' || p_brand || '"' AS quoted,
  p_name AS raw, CAST(NULL AS VARCHAR) AS nothing FROM part""",
)
def json_cast(spark: SparkSession, sf: str) -> DataFrame:
    data = "div.card::attr(data-json)"
    wanted = [
        E.css("first_id", data, json_cast=True, json_path="->'items'->[0]->>'id'"),
        E.css("n", data, json_cast=True, json_path="->n"),
        E.Spec("quoted", "jsonld", "Product.brand.name", as_text=False),
        E.css("raw", "h1", json_cast=True, json_path="->'x'"),
        E.css("nothing", data, json_cast=True, json_path="->'absent'"),
    ]
    return E.extract(DOC.product_pages(spark, sf), wanted, ["p_partkey"])


@query(
    "x27_array_expansion",
    """
SELECT p_partkey, CAST(unnest([p_partkey, p_partkey + 1]) AS VARCHAR) AS item FROM part
UNION ALL SELECT p_partkey, unnest(['a', 'b']) FROM part""",
)
def array_expansion(spark: SparkSession, sf: str) -> DataFrame:
    wanted = [
        E.css("ids", "div.card::attr(data-json)", expand=True, json_path="->'items'", array_field="id"),
        E.Spec("labels", "jsonld", "Product.variants", expand=True, array_field="label"),
    ]
    rows = E.extract(DOC.product_pages(spark, sf), wanted, ["p_partkey"])
    return rows.select("p_partkey", F.explode(F.concat("ids", "labels")).alias("item"))


@query(
    "x29_arrow_path",
    """
SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k, coalesce(json_extract_string(props, '$.missing'), '')
  AS missing, '"x"' AS json_text, 'x' AS bare FROM events""",
)
def arrow_path(spark: SparkSession, sf: str) -> DataFrame:
    nested = F.concat(F.lit('{"a":["x",'), "props", F.lit("]}"))
    return table(spark, sf, "events").select(
        "event_id",
        J.arrow(nested, "->'a'->1->>'k'").alias("k"),
        J.arrow("props", "->>'missing'").alias("missing"),
        J.arrow(nested, "->'a'->[0]").alias("json_text"),
        J.arrow(nested, "->a->>0").alias("bare"),
    )


@query(
    "x30_script_path",
    """
SELECT CAST(floor(o_orderkey / 20) AS BIGINT) AS page, CAST(min(o_orderkey) AS VARCHAR) AS first_id,
  arg_min(o_orderstatus, o_orderkey) AS first_status FROM orders GROUP BY 1""",
)
def script_path(spark: SparkSession, sf: str) -> DataFrame:
    wanted = [E.Spec("first_id", "js", "orders.0.id"), E.Spec("first_status", "js", "state[0].status")]
    return E.extract(DOC.order_pages(spark, sf), wanted, ["page"])


@query(
    "x31_x33_typed_fields",
    f"""
SELECT p_partkey, CAST({_MONEY} AS DOUBLE) AS price, CAST(p_size AS BIGINT) AS packs, upper(p_brand) AS brand,
  p_partkey % 3 <> 0 AS in_stock, p_name || ' & co' AS title FROM part""",
)
def typed_fields(spark: SparkSession, sf: str) -> DataFrame:
    wanted = [
        E.css("price", ".price::text", transforms=("trim",), type="DECIMAL"),
        E.css("packs", "p.size::text", type="INTEGER"),
        E.Spec("brand", "jsonld", "Product.brand.name", transforms=("uppercase",)),
        E.css("in_stock", "p.stock::text", transforms=("parse_stock",)),
        E.css("title", "title", transforms=("strip_html", "clean_text")),
    ]
    return E.extract(DOC.product_pages(spark, sf), wanted, ["p_partkey"])


@query(
    "x34_row_per_card",
    """
SELECT CAST(floor(p_partkey / 20) AS BIGINT) AS page, 'https://list.example/' || CAST(floor(p_partkey / 20) AS BIGINT) AS url,
  CAST(row_number() OVER (PARTITION BY floor(p_partkey / 20) ORDER BY p_partkey) - 1 AS INTEGER) AS place,
  CAST(p_partkey AS VARCHAR) AS id, p_name AS name, CAST(CAST(p_retailprice AS DECIMAL(14,2)) AS VARCHAR) AS price FROM part""",
)
def row_per_card(spark: SparkSession, sf: str) -> DataFrame:
    parts = {"id": ("", "attr:data-id"), "name": ("h2 > a", "text"), "price": (".price", "text")}
    return E.each_element(DOC.card_pages(spark, sf), "div.card", parts, ["page", "url"])


@query(
    "x34_row_per_entity",
    "SELECT p_partkey, 0 AS place, 'SKU-' || p_partkey AS sku FROM part",
)
def row_per_entity(spark: SparkSession, sf: str) -> DataFrame:
    rows = E.each_typed(DOC.product_pages(spark, sf), "Product", ["p_partkey"])
    return rows.select("p_partkey", "place", F.get_json_object("entity", "$.sku").alias("sku"))


@query(
    "x35_page_rules",
    """
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'SKU-' || p_partkey ELSE p_name END AS label,
  CASE WHEN p_partkey % 2 = 0 THEN 'none' END AS extra FROM part""",
)
def page_rules(spark: SparkSession, sf: str) -> DataFrame:
    even = F.col("p_partkey") % 2 == 0
    rules = [
        (even, [E.css("label", "[data-sku]::attr(data-sku)"), E.css("extra", "b.absent", default="none")]),
        (F.lit(True), [E.css("label", "h1")]),
    ]
    return E.extract_by_rule(DOC.product_pages(spark, sf), rules, ["p_partkey"])


@query(
    "x35_required_fields",
    """
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '["gone"]' ELSE '[]' END AS missing FROM part""",
)
def required_fields(spark: SparkSession, sf: str) -> DataFrame:
    wanted = [E.css("name", "h1", required=True), E.regex("gone", "(Only 2 left|In Stock)", required=True)]
    rows = E.extract(DOC.product_pages(spark, sf), wanted, ["p_partkey"])
    good, bad = E.split_required(rows, wanted)
    return good.select("p_partkey", F.lit("[]").alias("missing")).unionByName(
        bad.select("p_partkey", F.to_json("missing").alias("missing"))
    )


@query(
    "x36_regex_source",
    "SELECT p_partkey, CAST(p_size AS VARCHAR) AS packs, '/i/' || p_partkey || '.png' AS image FROM part",
)
def regex_source(spark: SparkSession, sf: str) -> DataFrame:
    wanted = [E.regex("packs", r"([0-9]+) x 250 ml"), E.css("image", "img[itemprop=image]::attr(src)")]
    return E.extract(DOC.product_pages(spark, sf), wanted, ["p_partkey"])


# --- tables -------------------------------------------------------------------

_CELLS = """
WITH o AS (SELECT CAST(floor(o_orderkey / 20) AS BIGINT) AS page, row_number() OVER (PARTITION BY floor(o_orderkey / 20)
  ORDER BY o_orderkey) - 1 AS row, * FROM orders),
c AS (SELECT page, row, 0 AS col, 'Order_No' AS name, CAST(o_orderkey AS VARCHAR) AS value FROM o
  UNION ALL SELECT page, row, 1, 'Status_Mark', o_orderstatus FROM o
  UNION ALL SELECT page, row, 2, 'column3', CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) FROM o
  UNION ALL SELECT page, row, 3, 'column4', CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) END FROM o)
"""


def order_cells(spark: SparkSession, sf: str) -> DataFrame:
    picked = _parsed(DOC.order_pages(spark, sf)).select(
        "page", H.table_struct("dom", "table", index=2, skip_citations=True).alias("t")
    )
    return H.cells(picked, ["page"])


@query(
    "t01_t06_table_cells",
    _CELLS + "SELECT page, CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col, name, value FROM c",
)
def table_cells(spark: SparkSession, sf: str) -> DataFrame:
    return order_cells(spark, sf)


@query(
    "t05_list_as_table",
    """
SELECT DISTINCT CAST(floor(o_orderkey / 20) AS BIGINT) AS page, unnest(['one', 'twothree', 'three']) AS item FROM orders""",
)
def list_as_table(spark: SparkSession, sf: str) -> DataFrame:
    picked = _parsed(DOC.order_pages(spark, sf)).select("page", H.table_struct("dom", "ul, ol").alias("t"))
    return H.cells(picked, ["page"]).select("page", F.col("value").alias("item"))


@query(
    "t07_column_types",
    """
SELECT CAST(unnest([0, 1, 2, 3]) AS INTEGER) AS col, unnest(['BIGINT', 'VARCHAR', 'DOUBLE', 'BIGINT']) AS type""",
)
def column_types(spark: SparkSession, sf: str) -> DataFrame:
    return H.column_types(order_cells(spark, sf), ["col"])


@query(
    "t08_s09_read_html",
    """
SELECT CAST(floor(o_orderkey / 20) AS BIGINT) AS page, o_orderkey AS "Order_No", o_orderstatus || '[1]' AS "Status_Mark",
  CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS column3,
  CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS column4 FROM orders""",
)
def read_html(spark: SparkSession, sf: str) -> DataFrame:
    return H.read_html(DOC.order_pages(spark, sf), ["page"], "table.orders").drop("row")


@query(
    "t09_script_table",
    """
SELECT CAST(floor(o_orderkey / 20) AS BIGINT) AS page, o_orderkey % 2 = 0 AS even_flag, o_orderkey AS id,
  o_orderstatus AS status, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS total FROM orders""",
)
def script_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = H.read_html(DOC.order_pages(spark, sf), ["page"], "@$orders")
    return rows.select("page", (F.col("even") == "true").alias("even_flag"), "id", "status", "total")


@query(
    "t08_two_shapes",
    """
SELECT CAST(c_custkey AS BIGINT) AS page, CAST(0 AS INTEGER) AS row, CAST(c_custkey AS BIGINT) AS code,
  CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS segment, CASE WHEN c_custkey % 2 = 1 THEN c_custkey + 0.5 END::DOUBLE AS score,
  CASE WHEN c_custkey % 2 = 1 THEN CAST(c_nationkey AS BIGINT) END AS column3 FROM customer""",
)
def tables_of_two_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """Pages whose tables differ: other columns, one without a header, rows shorter than the header."""
    text = lambda c: F.col(c).cast("string")
    even = F.concat(
        F.lit("<table><tr><th>code</th><th>segment</th><th></th></tr><tr><td>"), text("c_custkey"), F.lit("</td><td>"), "c_mktsegment", F.lit("</td></tr></table>")
    )
    odd = F.concat(
        F.lit("<table><tr><th>score</th><th>code</th><th></th></tr><tr><td>"), text("c_custkey"), F.lit(".5</td><td>"), text("c_custkey"),
        F.lit("</td><td>"), text("c_nationkey"), F.lit("</td></tr></table>"),
    )
    customers = table(spark, sf, "customer")
    pages = customers.select(F.col("c_custkey").cast("long").alias("page"), F.when(F.col("c_custkey") % 2 == 0, even).otherwise(odd).alias("html"))
    return H.read_html(pages, ["page"])
