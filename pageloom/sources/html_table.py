"""HTML tables, lists and script arrays as relations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions import dom as D
from pageloom.functions import json_path as J
from pageloom.functions import script_vars as S
from pageloom.functions.columns import ColumnOrName, col, let, unpack
from pageloom.session import cut_lineage

# Marks that may not stay in a column name.
NAME_MARKS = r"[ \-/\\(),]"


def _citations(dom: Column) -> Column:
    """Flags of the elements that are, or lie in, a mark of a reference."""

    def is_citation(n: Column) -> Column:
        marked = F.startswith(F.coalesce(D.attr(n, "id"), F.lit("")), F.lit("cite_ref")) | F.contains(
            F.coalesce(D.attr(n, "class"), F.lit("")), F.lit("reference")
        )
        return (n["tag"] == "sup") & marked

    return D.within(dom, F.filter(dom["nodes"], is_citation))


def _cell_text(dom: Column, node: Column, skipped: Column | None) -> Column:
    chunks = F.slice(dom["chunks"], node["c0"] + 1, node["c1"] - node["c0"])
    if skipped is not None:
        chunks = F.filter(chunks, lambda c: ~D.flagged(skipped, c["node"]))
    joined = F.array_join(F.transform(chunks, lambda c: c["text"]), "")
    return F.trim(F.regexp_replace(joined, r"\s+", " "))


def table_struct(
    dom: ColumnOrName, selector: str = "table", index: int = 1, skip_citations: bool = False
) -> Column:
    """``struct(headers, rows)`` of the ``index``-th match (from 1); NULL if there is none.

    Lists become one column ``item``.  Headers come from ``thead``, else from every
    ``th``, else from the first row, which then also stays a data row.
    """
    if index < 1:
        raise ValueError("table index starts at 1")
    dom = col(dom)
    nodes = dom["nodes"]

    def build(root: Column, skipped: Column | None) -> Column:
        inside = D.descendants(dom, root)
        is_list = root["tag"].isin("ul", "ol")

        def cells(found: Column) -> Column:
            return F.transform(found, lambda n: _cell_text(dom, n, skipped))

        def from_list(below: Column) -> Column:
            items = cells(F.filter(below, lambda n: n["tag"] == "li"))
            return F.struct(
                F.array(F.lit("item")).alias("headers"), F.transform(items, lambda t: F.array(t)).alias("rows")
            )

        def from_table(below: Column) -> Column:
            row = lambda n: n["tag"] == "tr"
            marks = {
                "tr": row,
                "first": lambda n: row(n) & (n["sib"] == 0),
                "thead": lambda n: n["tag"] == "thead",
                "tbody": lambda n: n["tag"] == "tbody",
            }
            flags = F.struct(*[D.inside(dom, F.filter(nodes, test)).alias(name) for name, test in marks.items()])
            return let(flags, lambda known: read_table(below, lambda n, name: D.flagged(known[name], n["id"])))

        def read_table(below: Column, under: Callable[[Column, str], Column]) -> Column:
            heads = F.filter(below, lambda n: (n["tag"] == "th") & under(n, "tr"))
            thead_cells = F.filter(heads, lambda n: under(n, "thead"))
            first_cells = F.filter(below, lambda n: (n["tag"] == "td") & under(n, "first"))
            headers = F.when(F.size(thead_cells) > 0, thead_cells).when(F.size(heads) > 0, heads).otherwise(first_cells)

            def row_cells(tr: Column) -> Column:
                parts = D.descendants(dom, tr)
                data = F.filter(parts, lambda n: n["tag"] == "td")
                return cells(data)

            body_rows = F.filter(below, lambda n: (n["tag"] == "tr") & under(n, "tbody"))
            rows = F.filter(F.transform(body_rows, row_cells), lambda r: F.size(r) > 0)
            return let(
                F.struct(cells(headers).alias("h"), rows.alias("r")),
                lambda t: F.struct(
                    F.concat(t["h"], _padding(F.size(t["h"]), F.greatest(F.size(t["h"]), F.coalesce(F.size(F.get(t["r"], F.lit(0))), F.lit(0))))).alias("headers"),
                    t["r"].alias("rows"),
                ),
            )

        whole = F.when(is_list, let(inside, from_list)).otherwise(let(inside, from_table))
        return F.when(root.isNotNull(), whole)

    root = F.get(D.select(dom, selector), F.lit(index - 1))
    if skip_citations:
        return let(_citations(dom), lambda skipped: let(root, lambda r: build(r, skipped)))
    return let(root, lambda r: build(r, None))


def _padding(have: Column, want: Column) -> Column:
    numbers = F.when(want > have, F.sequence(have + 1, F.greatest(want, have + 1))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(numbers, lambda i: F.concat(F.lit("column"), i.cast("string")))


def cells(tables: DataFrame, keep: list[str], struct: str = "t") -> DataFrame:
    """Long form: ``keep``, row, col (both from 0), name, value (empty as NULL).

    Columns beyond the headers are left out.
    """
    rows = unpack(tables, [*keep, F.col(f"{struct}.headers").alias("headers")], F.col(f"{struct}.rows"), "row", "cells")
    named = F.transform(
        "headers",
        lambda h, i: F.struct(column_name(h, i).alias("name"), F.get("cells", i).alias("value")),
    )
    return unpack(rows, [*keep, "row"], named, "col", "cell").select(
        *keep, "row", "col", F.col("cell.name").alias("name"), F.nullif(F.col("cell.value"), F.lit("")).alias("value")
    )


def column_name(header: Column, place: Column) -> Column:
    """Header as a column name; an empty one is numbered."""
    filled = F.when(header == "", F.concat(F.lit("column"), (place + 1).cast("string"))).otherwise(header)
    return F.regexp_replace(filled, NAME_MARKS, "_")


def is_integer(value: Column) -> Column:
    whole = F.regexp_extract(value, r"^\s*([+-]?[0-9]+)\s*$", 1)
    return F.when(value.isNotNull(), (whole != "") & whole.try_cast("bigint").isNotNull())


def is_number(value: Column) -> Column:
    return value.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$")


def column_types(long_cells: DataFrame, keys: list[str]) -> DataFrame:
    """Inferred type per column: BIGINT, DOUBLE or VARCHAR; one partial aggregate."""
    value = F.col("value")
    grouped = long_cells.groupBy(*keys).agg(
        F.count(value).alias("_n"),
        F.bool_and(is_integer(value)).alias("_whole"),
        F.bool_and(is_number(value)).alias("_number"),
    )
    kind = F.when(F.col("_n") == 0, "VARCHAR").when(F.col("_whole"), "BIGINT").when(F.col("_number"), "DOUBLE")
    return grouped.select(*keys, F.coalesce(kind, F.lit("VARCHAR")).alias("type"))


#: A relation has so many columns at most; more names over all pages are an error.
MOST_COLUMNS = 10_000
_SPARK_TYPES = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string"}


def _typed(value: Column, kind: str) -> Column:
    return value if kind == "VARCHAR" else F.trim(value).try_cast(_SPARK_TYPES[kind])


def _shape(types: DataFrame) -> list[tuple[str, str]]:
    """Name and type of every column, by first place and name; one row per name reaches the driver."""
    found = types.select("place", "name", "type").limit(MOST_COLUMNS + 1).collect()
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"the pages have more than {MOST_COLUMNS} different columns")
    return [(r["name"], r["type"]) for r in sorted(found)]


def typed_rows(long_cells: DataFrame, keys: list[str]) -> DataFrame:
    """Wide form of long cells with inferred column types; columns of one name are one column.

    The cells are written out once, as both the types and the rows come from them.
    """
    long_cells = cut_lineage(long_cells)
    places = long_cells.groupBy("name").agg(F.min("col").alias("place"))
    shape = _shape(column_types(long_cells, ["name"]).join(places, "name"))
    wide = long_cells.groupBy(*keys, "row").pivot("name", [n for n, _ in shape]).agg(F.first("value"))
    return wide.select(*keys, "row", *[_typed(F.col(f"`{n}`"), kind).alias(n) for n, kind in shape])


def _own_names(headers: Column) -> Column:
    """Column names of one table; a repeated one is numbered."""
    names = F.transform(headers, column_name)
    return let(
        names,
        lambda all_names: F.transform(
            all_names,
            lambda n, i: let(
                F.size(F.filter(F.slice(all_names, F.lit(1), i), lambda x: x == n)),
                lambda before: F.when(before == 0, n).otherwise(F.concat(n, F.lit("_"), before.cast("string"))),
            ),
        ),
    )


def typed_tables(tables: DataFrame, keys: list[str], struct: str = "t") -> DataFrame:
    """Typed rows of one table per page; pages may differ in shape.

    Columns of one name are one column, NULL on pages without it.  A page's table stays
    in its row: types come from one aggregate over page columns, cells are taken by
    place, and neither the types nor the rows shuffle cells.  Tables are written out once,
    so that no page is parsed again for its rows.
    """
    held = tables.select(*keys, _own_names(F.col(f"{struct}.headers")).alias("_names"), F.col(f"{struct}.rows").alias("_rows"))
    held = cut_lineage(held.filter(F.col("_names").isNotNull()))

    def column(name: Column, i: Column) -> Column:
        values = F.filter(F.transform("_rows", lambda r: F.nullif(F.get(r, i), F.lit(""))), lambda v: v.isNotNull())
        return let(
            values,
            lambda v: F.struct(
                name.alias("name"), F.size(v).alias("n"), F.forall(v, is_integer).alias("whole"), F.forall(v, is_number).alias("number")
            ),
        )

    opened = unpack(held, [], F.transform("_names", column), "place", "c").select("place", "c.*")
    kind = F.when(F.col("n") == 0, "VARCHAR").when(F.col("whole"), "BIGINT").when(F.col("number"), "DOUBLE").otherwise("VARCHAR")
    types = opened.groupBy("name").agg(
        F.min("place").alias("place"), F.sum("n").alias("n"), F.bool_and("whole").alias("whole"), F.bool_and("number").alias("number")
    )
    shape = _shape(types.select("place", "name", kind.alias("type")))
    rows = unpack(held, [*keys, "_names"], F.col("_rows"), "row", "_cells")
    at = lambda name: F.nullif(F.get("_cells", F.nullif(F.array_position("_names", F.lit(name)), F.lit(0)) - 1), F.lit(""))
    return rows.select(*keys, "row", *[_typed(at(name), kind).alias(name) for name, kind in shape])


def read_html(
    pages: DataFrame, keys: list[str], selector: str = "table", index: int = 1, html: str = "html", url: str | None = None
) -> DataFrame:
    """Typed rows of a table on every page; pages may differ in the shape of their tables.

    ``@$name`` reads a script variable instead.  Citation marks are dropped on
    pages of wikipedia.org when ``url`` is given.
    """
    if "@$" in selector:
        before, _, name = selector.partition("@$")
        parsed = pages.select(*keys, D.parse(html).alias("dom"))
        value = S.variable_of("dom", before.strip() or "script", name.strip())
        return typed_rows(variable_cells(parsed.select(*keys, value.alias("v")), keys, "v"), keys)
    parsed = pages.withColumn("dom", D.parse(html))
    plain = table_struct("dom", selector, index)
    if url:
        is_wiki = F.contains(F.col(url), F.lit("wikipedia.org"))
        plain = F.when(is_wiki, table_struct("dom", selector, index, True)).otherwise(plain)
    return typed_tables(parsed.select(*keys, plain.alias("t")), keys)


def variable_cells(values: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Long form of a JSON value: an array of objects gives a column per key, an array
    of other values the column ``value``, an object ``key`` and ``value``.

    Columns are the sorted keys of all objects; cells of missing keys have no row.
    """
    value = F.col(column)
    no_names = F.array().cast("array<string>")

    def keys_of(text: Column) -> Column:
        return F.coalesce(F.json_object_keys(text), no_names)

    def split(items: Column) -> Column:
        names = F.array_sort(F.array_distinct(F.flatten(F.transform(items, keys_of))))
        return F.struct(names.alias("names"), items.alias("items"))

    opened = values.select(
        *keys,
        F.when(F.startswith(value, F.lit("[")), let(J.array_items(value), split))
        .when(
            F.startswith(value, F.lit("{")),
            F.struct(
                F.array(F.lit("key"), F.lit("value")).alias("names"),
                F.transform(
                    F.map_entries(F.from_json(value, "map<string,string>")),
                    lambda e: F.to_json(F.struct(e["key"].alias("key"), e["value"].alias("value"))),
                ).alias("items"),
            ),
        )
        .when(value.isNotNull(), F.struct(no_names.alias("names"), F.array(value).alias("items")))
        .alias("_v"),
    )
    rows = unpack(opened, [*keys, F.col("_v.names").alias("_names")], F.col("_v.items"), "row", "_item")
    # Each object is read once; its entries become cells.
    entries = F.when(F.size("_names") > 0, F.map_entries(F.from_json("_item", "map<string,string>"))).otherwise(
        F.array(F.struct(F.lit("value").alias("key"), J.as_text(F.col("_item")).alias("value")))
    )
    return unpack(rows, [*keys, "row", "_names"], entries, "_i", "_e").select(
        *keys,
        "row",
        F.greatest(F.array_position("_names", F.col("_e.key")) - 1, F.lit(0)).cast("int").alias("col"),
        F.col("_e.key").alias("name"),
        F.nullif(F.col("_e.value"), F.lit("")).alias("value"),
    )
