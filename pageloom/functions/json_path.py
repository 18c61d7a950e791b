"""Paths into JSON texts, as column expressions on variants."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.functions.columns import ColumnOrName, col, let


def variant_path(parts: list[str]) -> str:
    """Whole numbers are array places, everything else is a key."""
    return "$" + "".join(f"[{p}]" if p.isdigit() else "[" + "'" + p + "']" for p in parts)


def json_at(text: ColumnOrName, parts: list[str]) -> Column:
    """JSON text of the value at a path; NULL for bad JSON or a missing value."""
    return F.to_json(_at(text, parts))


def _at(text: ColumnOrName, parts: list[str]) -> Column:
    value = F.try_parse_json(col(text))
    return F.try_variant_get(value, variant_path(parts), "variant") if parts else value


def as_text(json_text: Column) -> Column:
    """Bare text of a JSON value: strings without quotes, null as NULL, the rest as JSON."""
    bare = F.try_variant_get(F.try_parse_json(json_text), "$", "string")
    return F.when(F.startswith(json_text, F.lit('"')), bare).when(json_text != "null", json_text)


def array_items(text: ColumnOrName, parts: list[str] | None = None) -> Column:
    """JSON texts of the elements of a JSON array, at ``parts`` inside each element.

    Elements without the value are dropped; NULL if the text is no array.
    """
    items = F.try_variant_get(F.try_parse_json(col(text)), "$", "array<variant>")
    if parts:
        items = F.transform(items, lambda v: F.try_variant_get(v, variant_path(parts), "variant"))
    return F.filter(F.transform(items, lambda v: F.to_json(v)), lambda t: t.isNotNull())


def json_array(texts: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))


def split_path(path: str) -> list[str]:
    """``a.b[0].c`` as a list of parts."""
    return [p for p in re.split(r"[.\[\]]+", path) if p]


_ARROW = re.compile(r"\s*->(>?)\s*(?:'([^']*)'|\"([^\"]*)\"|\[(\d+)\]|([^\s'\"\[\]>-]+))")


def arrow_parts(path: str) -> tuple[list[str], bool]:
    """Parts of ``->'a'->>0`` and whether the last arrow asks for text."""
    parts, text, at = [], False, 0
    while at < len(path.rstrip()):
        found = _ARROW.match(path, at)
        if not found:
            break
        text = bool(found[1])
        parts.append(next(g for g in found.groups()[1:] if g is not None))
        at = found.end()
    return parts, text


def arrow(text: ColumnOrName, path: str) -> Column:
    """Value of an arrow path; an empty string for a wrong type or a missing value."""
    parts, bare = arrow_parts(path)
    if not parts:
        return F.lit("")
    found = json_at(text, parts)
    value = let(found, as_text) if bare else found
    return F.coalesce(value, F.lit(""))
