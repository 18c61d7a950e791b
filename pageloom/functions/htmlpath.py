"""``selector@attribute[*].path``: one value of a page as JSON."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.functions import dom as D
from pageloom.functions import json_path as J
from pageloom.functions import script_vars as S
from pageloom.functions.columns import ColumnOrName, col, let


def htmlpath(html: ColumnOrName, path: str, dom: ColumnOrName | None = None) -> Column:
    """JSON text of a value, ``null`` where there is none.

    ``@text`` and ``@html`` read the first match, other names its attribute, and
    ``@$name`` a script variable.  A path or ``[*]`` parses the value as JSON.
    """
    return F.coalesce(_value(html, path, dom), F.lit("null"))


def _value(html: ColumnOrName, path: str, dom: ColumnOrName | None) -> Column:
    nothing = F.lit(None).cast("string")
    selector, at, rest = path.strip().rpartition("@")
    found = re.match(r"[^\[.]+", rest)
    if not at or not found:
        return nothing
    name, tail, selector = found[0], rest[found.end() :], selector.strip()
    each = "[*]" in tail
    parts = J.split_path(tail.replace("[*]", "."))
    html = col(html)
    dom = D.parse(html) if dom is None else col(dom)
    try:
        if name.startswith("$"):
            json_text = S.variable_of(dom, selector or "script", name[1:])
            return _walk(json_text, each, parts) if each or parts else json_text
        if not selector:
            return nothing
        node = D.select_first(dom, selector)
    except D.SelectorError:
        return nothing
    if name in ("text", "innerText"):
        raw = let(node, lambda n: D.text(dom, n))
    elif name in ("html", "innerHTML"):
        raw = let(node, lambda n: D.inner_html(html, n))
    else:
        raw = let(node, lambda n: D.attr(n, name.lower()))
    if each or parts:
        return _walk(raw, each, parts)
    return let(raw, lambda r: F.when(r.isNotNull(), quoted(r)))


def _walk(text: Column, each: bool, parts: list[str]) -> Column:
    return J.json_array(J.array_items(text, parts)) if each else J.json_at(text, parts)


def quoted(text: Column) -> Column:
    """A text as a JSON string."""
    return F.regexp_extract(F.to_json(F.struct(text.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)


def json_object(values: Column) -> Column:
    """JSON object of a map whose values are JSON texts already."""
    pairs = F.transform(F.map_entries(values), lambda e: F.concat(quoted(e["key"]), F.lit(":"), e["value"]))
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))
