"""Values assigned to script variables and the JSON pieces of script elements.

A short reader takes literals out of script text: it never runs code and knows
strings, numbers, booleans, null, arrays, objects, plain templates and
``JSON.parse('...')``.  Anything else is unsupported: it drops an object and
becomes null in an array.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions import dom as D
from pageloom.functions import tags
from pageloom.functions.columns import ColumnOrName, col, last_wins, let, pieces

# Names under which frameworks keep their page state.
HYDRATION_NAMES = (
    "__NEXT_DATA__",
    "__NUXT__",
    "__INITIAL_STATE__",
    "__PRELOADED_STATE__",
    "__DATA__",
    "__APOLLO_STATE__",
    "__RELAY_STORE__",
    "__REDUX_STATE__",
)

_SPACE = re.compile(r"\s*+(?:(?:/\*.*?\*/|//[^\n]*)\s*+)*", re.S)
_STRING = re.compile(r"\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'", re.S)
_TEMPLATE = re.compile(r"`((?:[^`\\$]|\\.|\$(?!\{))*)`", re.S)
_NUMBER = re.compile(r"-?\s*(?:0[xX][0-9a-fA-F]+|(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)(?![\w.])")
_WORD = re.compile(r"[A-Za-z_$][\w$]*")
_PARSE = re.compile(r"JSON\s*\.\s*parse\s*\(")
_ESCAPE = re.compile(r"\\(?:x([0-9a-fA-F]{2})|u([0-9a-fA-F]{4})|u\{([0-9a-fA-F]+)\}|(\r?\n)|(.))", re.S)
_SHORT = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "v": "\v", "0": "\0"}
_ASSIGN = re.compile(r"(?:(var|let|const)\s+)?(window\s*\.\s*)?([A-Za-z_$][\w$]*)\s*=(?![=>])")
_SKIPPED = re.compile(r"\"(?:[^\"\\]|\\.)*\"|'(?:[^'\\]|\\.)*'|`(?:[^`\\]|\\.)*`|/\*.*?\*/|//[^\n]*|[{}()\[\];\n]", re.S)
# What may end an unsupported value or change its level; strings and templates are passed as a whole.
_LEVEL = re.compile(rf"{_STRING.pattern}|{_TEMPLATE.pattern}|([(\[{{)\]}},;])", re.S)
_MISSING = object()
_MOST_DIGITS = 4_000
# Per script, literals that are tried as JSON in vain; per literal, brackets that need no look at their depth.
_MOST_TRIES = 16
_SHALLOW = 100


def _read_value(text: str, at: int, tries: list[int]) -> tuple[object, int]:
    """:func:`read_literal`; a literal that is nested too deeply is dropped like an unsupported one."""
    try:
        return read_literal(text, at, tries)
    except RecursionError:
        return _MISSING, _end_of_value(text, at)


@lru_cache(4096)
def _escaped(mark: str) -> str:
    found = _ESCAPE.fullmatch(mark)
    code = found[1] or found[2] or found[3]
    if code:
        return chr(int(code, 16)) if int(code, 16) < 0x110000 else "\ufffd"
    return "" if found[4] else _SHORT.get(found[5], found[5])


def _unescape(body: str) -> str:
    joined = _ESCAPE.sub(lambda found: _escaped(found[0]), body) if "\\" in body else body
    return joined if joined.isascii() else joined.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _end_of_value(text: str, at: int) -> int:
    """Where an unsupported value ends: the next comma or closing mark of its level."""
    depth = 0
    for found in _LEVEL.finditer(text, at):
        mark = found[found.lastindex] if found.lastindex == _LEVEL.groups else ""
        if not mark:
            continue
        if mark in "([{":
            depth += 1
        elif mark in ")]}":
            if depth == 0:
                return found.start()
            depth -= 1
        elif depth == 0:
            return found.start()
    return len(text)


def _json_int(digits: str) -> int:
    if len(digits) > _MOST_DIGITS:
        raise ValueError(digits)
    return int(digits)


def _json_float(digits: str) -> int | float:
    value = float(digits)
    if not math.isfinite(value):
        raise ValueError(digits)
    return int(value) if value == int(value) else value


def _json_constant(name: str) -> None:
    raise ValueError(name)


_SCAN = json.JSONDecoder(parse_int=_json_int, parse_float=_json_float, parse_constant=_json_constant).scan_once


def _is_deep(value: object, limit: int) -> bool:
    level = [value]
    for _ in range(limit):
        level = [c for v in level for c in (v.values() if isinstance(v, dict) else v) if isinstance(c, dict | list)]
        if not level:
            return False
    return True


def _read_json(text: str, at: int, tries: list[int]) -> tuple[object, int] | None:
    """An array or object that is plain JSON, read at once; None for any other, which is read piece by piece.

    What the two ways would read differently counts as other: codes of characters, which may be halves of a
    pair, and deep nesting.  A failed try costs time in proportion to the script, so ``tries`` are counted.
    """
    if tries[0] <= 0:
        return None
    try:
        value, after = _SCAN(text, at)
        brackets = text.count("[", at, after) + text.count("{", at, after)
        if text.find("\\u", at, after) < 0 and (brackets < _SHALLOW or not _is_deep(value, _SHALLOW)):
            return value, after
    except (ValueError, StopIteration, RecursionError):
        pass
    tries[0] -= 1
    return None


def read_literal(text: str, at: int, tries: list[int] | None = None) -> tuple[object, int]:
    """Value that starts at a position, or ``_MISSING``, and the position after it.

    ``tries`` holds how many more literals of the text may be tried as JSON.
    """
    tries = [_MOST_TRIES] if tries is None else tries
    at = _SPACE.match(text, at).end()
    if text[at : at + 1] in ("[", "{"):
        whole = _read_json(text, at, tries)
        if whole:
            return whole
        return (_read_array if text[at] == "[" else _read_object)(text, at + 1, tries)
    found = _STRING.match(text, at)
    if found:
        return _unescape(found[0][1:-1]), found.end()
    found = _TEMPLATE.match(text, at)
    if found:
        return found[1], found.end()
    found = _NUMBER.match(text, at)
    if found:
        digits = found[0].replace(" ", "")
        sign, digits = (-1, digits[1:].strip()) if digits.startswith("-") else (1, digits)
        if digits[:2] in ("0x", "0X"):
            return sign * int(digits, 16), found.end()
        if digits.isdigit():
            # Within the digits that Python converts, integers stay exact.
            return (sign * int(digits) if len(digits) <= _MOST_DIGITS else _MISSING), found.end()
        value = float(digits)
        if not math.isfinite(value):
            return _MISSING, found.end()
        return sign * (int(value) if value == int(value) else value), found.end()
    found = _PARSE.match(text, at)
    if found:
        value, after = read_literal(text, found.end(), tries)
        after = _SPACE.match(text, after).end()
        if isinstance(value, str) and text[after : after + 1] == ")":
            try:
                return json.loads(value), after + 1
            except (ValueError, RecursionError):
                pass
        return _MISSING, _end_of_value(text, at)
    found = _WORD.match(text, at)
    if found and found[0] in ("true", "false", "null"):
        return {"true": True, "false": False, "null": None}[found[0]], found.end()
    return _MISSING, _end_of_value(text, at)


def _settled(text: str, value: object, after: int) -> tuple[object, int]:
    """A literal that goes on as an expression is no literal."""
    after = _SPACE.match(text, after).end()
    if after < len(text) and text[after] not in ",]})":
        return _MISSING, _end_of_value(text, after)
    return value, after


def _read_array(text: str, at: int, tries: list[int]) -> tuple[object, int]:
    values: list[object] = []
    while True:
        at = _SPACE.match(text, at).end()
        if at >= len(text):
            return _MISSING, at
        if text[at] == "]":
            return values, at + 1
        if text[at] == ",":
            values.append(None)
            at += 1
            continue
        value, at = _settled(text, *read_literal(text, at, tries))
        values.append(None if value is _MISSING else value)
        if text[at : at + 1] == ",":
            at += 1
        elif text[at : at + 1] != "]":
            return _MISSING, at


def _read_object(text: str, at: int, tries: list[int]) -> tuple[object, int]:
    values: dict[str, object] = {}
    whole = True
    while True:
        at = _SPACE.match(text, at).end()
        if at >= len(text):
            return _MISSING, at
        if text[at] == "}":
            return (values if whole else _MISSING), at + 1
        name = _STRING.match(text, at) or _WORD.match(text, at) or _NUMBER.match(text, at)
        colon = _SPACE.match(text, name.end()).end() if name else at
        if name and text[colon : colon + 1] == ":":
            key = _unescape(name[0][1:-1]) if name[0][0] in "\"'" else name[0]
            value, at = _settled(text, *read_literal(text, colon + 1, tries))
            if value is _MISSING:
                whole = False
            else:
                values[key] = value
        else:
            # Spread, shorthand and methods add nothing.
            at = _end_of_value(text, at)
        if text[at : at + 1] == ",":
            at += 1
        elif text[at : at + 1] != "}":
            return _MISSING, at


def assignments(source: str, window: bool = False) -> list[tuple[str, object]]:
    """Top-level assignments of a script in order, supported values only."""
    found: list[tuple[str, object]] = []
    at, depth, fresh = 0, 0, True
    tries = [_MOST_TRIES]
    while at < len(source):
        at = _SPACE.match(source, at).end()
        start = _ASSIGN.match(source, at) if fresh and depth == 0 else None
        if start:
            declared = start[1]
            while start:
                value, after = _read_value(source, start.end(), tries)
                after = _SPACE.match(source, after).end()
                ended = after >= len(source) or source[after] in ",;}" or "\n" in source[start.end() : after]
                if value is not _MISSING and (ended or _ASSIGN.match(source, after)):
                    if window or not start[2]:
                        found.append((start[3], value))
                    at = after
                else:
                    at = max(start.end(), after) if value is _MISSING else _end_of_value(source, after)
                more = declared and source[at : at + 1] == ","
                start = _ASSIGN.match(source, _SPACE.match(source, at + 1).end()) if more else None
            fresh = True
            if source[at : at + 1] in (";", ","):
                at += 1
            continue
        mark = _SKIPPED.search(source, at)
        if not mark:
            break
        if mark[0] in "{([":
            depth += 1
        elif mark[0] in "})]":
            depth = max(depth - 1, 0)
        fresh = mark[0] in ("}", ";", "\n")
        at = mark.end()
    return found


_VARIABLES = T.MapType(T.StringType(), T.StringType())
_ENCODER = json.JSONEncoder(ensure_ascii=False, separators=(",", ":"), sort_keys=True, allow_nan=False)


def _json(value: object) -> str:
    """JSON text; ValueError or RecursionError for a value that has none."""
    return _ENCODER.encode(value)


def _collect(script: str, into: dict[str, str], window: bool, keep_first: bool, containers: bool) -> None:
    for name, value in assignments(script, window):
        if (keep_first and name in into) or (containers and not isinstance(value, dict | list)):
            continue
        try:
            into[name] = _json(value)
        except (ValueError, RecursionError):
            continue


def _per_page(scripts: pa.Array, window: bool, keep_first: bool, containers: bool) -> pa.Array:
    rows = []
    for page in scripts.to_pylist():
        values: dict[str, str] = {}
        for script in page or ():
            _collect(script, values, window, keep_first, containers)
        rows.append(sorted(values.items()))
    return pa.array(rows, pa.map_(pa.string(), pa.string()))


@F.arrow_udf(_VARIABLES)
def _plain(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for scripts in (piece for whole in batches for piece in pieces(whole)):
        yield _per_page(scripts, window=False, keep_first=False, containers=False)


@F.arrow_udf(_VARIABLES)
def _with_window(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for scripts in (piece for whole in batches for piece in pieces(whole)):
        yield _per_page(scripts, window=True, keep_first=True, containers=True)


@F.arrow_udf(T.ArrayType(_VARIABLES))
def _per_script(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for scripts in (piece for whole in batches for piece in pieces(whole)):
        rows = []
        for page in scripts.to_pylist():
            maps = []
            for script in page or ():
                values: dict[str, str] = {}
                _collect(script, values, window=False, keep_first=False, containers=False)
                maps.append(sorted(values.items()))
            rows.append(maps)
        yield pa.array(rows, pa.list_(pa.map_(pa.string(), pa.string())))


def script_texts(html: ColumnOrName) -> Column:
    """Bodies of plain scripts (no type, or text/javascript), in page order."""
    clean = F.regexp_replace(col(html), r"(?s)<!--.*?(?:-->|\z)", "")
    pattern = (
        r"(?is)<script(?:(?![^>]*\stype\s*=)|(?=[^>]*\stype\s*=\s*[\"']?text/javascript[\"'\s>]))[^>]*>(.*?)</script"
    )
    return F.regexp_extract_all(clean, F.lit(pattern), F.lit(1))


def variables(html: ColumnOrName) -> Column:
    """Map of variable to JSON text; the last assignment wins."""
    return _plain(script_texts(html))


def state_variables(html: ColumnOrName) -> Column:
    """Objects and arrays only, ``window.X`` too; the first assignment wins."""
    return _with_window(script_texts(html))


def variable_of(dom: ColumnOrName, selector: str, name: str) -> Column:
    """JSON text of a variable in the first matching element that defines it."""
    texts = F.transform(D.select(dom, selector), lambda n: D.raw_text(dom, n))
    defining = F.filter(_per_script(texts), lambda m: F.map_contains_key(m, name))
    return F.try_element_at(F.get(defining, F.lit(0)), F.lit(name))


def hydration(html: ColumnOrName) -> Column:
    """Map of the known state names to JSON text.

    A script element with the name as id comes before an assignment.
    """
    clean = F.regexp_replace(col(html), r"(?s)<!--.*?(?:-->|\z)", "")

    def by_id(name: str) -> Column:
        pattern = rf"(?is)<script[^>]*\sid\s*=\s*[\"']?{name}[\"'\s>][^<]*?>?\s*([\[{{].*?)\s*</script"
        body = F.nullif(F.regexp_extract(clean, pattern, 1), F.lit(""))
        return F.when(F.try_parse_json(body).isNotNull(), body)

    assigned = state_variables(html)

    def pairs(held: Column) -> Column:
        found = F.array(
            *(
                F.struct(
                    F.lit(n).alias("key"),
                    F.coalesce(by_id(n), F.try_element_at(held, F.lit(n))).alias("value"),
                )
                for n in HYDRATION_NAMES
            )
        )
        return F.map_from_entries(F.filter(found, lambda p: p["value"].isNotNull()))

    return let(assigned, pairs)


# --- JSON-LD ------------------------------------------------------------------

_TYPED_ITEMS = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
)
_SCHEMA_ORG = re.compile(r"^https?://schema\.org/")
_COMMENT = re.compile(r"(\"(?:[^\"\\]|\\.)*\")|/\*.*?\*/|//[^\n]*", re.S)
_TRAILING_COMMA = re.compile(r"(\"(?:[^\"\\]|\\.)*\")|,(?=\s*[}\]])", re.S)


def typed_objects(value: object, strict: bool = True) -> list[tuple[str, object]]:
    """Objects with an ``@type`` in a JSON-LD value, those of a graph before their carrier.

    ``strict=False``: only the first type counts and a graph replaces its carrier.
    """
    if isinstance(value, list):
        return [pair for item in value for pair in typed_objects(item, strict)]
    if not isinstance(value, dict):
        return []
    graph = value.get("@graph")
    inside = [p for item in graph for p in typed_objects(item, strict)] if isinstance(graph, list) else []
    if inside and not strict:
        return inside
    kinds = value.get("@type")
    kinds = [kinds] if isinstance(kinds, str) else [k for k in kinds or () if isinstance(k, str)] if isinstance(kinds, list) else []
    kinds = kinds if strict else kinds[:1]
    return inside + [(_SCHEMA_ORG.sub("", k), value) for k in kinds]


def _items(scripts: pa.Array, strict: bool) -> pa.Array:
    rows = []
    for page in scripts.to_pylist():
        found: list[dict[str, str]] = []
        for body in page or ():
            if not strict:
                body = _TRAILING_COMMA.sub(r"\1", _COMMENT.sub(r"\1", body))
            try:
                found += [{"key": k, "value": _json(v)} for k, v in typed_objects(json.loads(body), strict)]
            except (ValueError, RecursionError):
                # No JSON, or nested beyond what can be read: the script gives nothing.
                continue
        rows.append(found)
    kind = pa.list_(pa.struct([("key", pa.string()), ("value", pa.string())]))
    return pa.array(rows, kind)


@F.arrow_udf(_TYPED_ITEMS)
def _strict_items(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for scripts in (piece for whole in batches for piece in pieces(whole)):
        yield _items(scripts, strict=True)


@F.arrow_udf(_TYPED_ITEMS)
def _lenient_items(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for scripts in (piece for whole in batches for piece in pieces(whole)):
        yield _items(scripts, strict=False)


def jsonld_items(html: ColumnOrName, strict: bool = True) -> Column:
    """Array of type/JSON structs of all JSON-LD scripts, in page order."""
    bodies = tags.scripts_of_type(html, "application/ld+json")
    return _strict_items(bodies) if strict else _lenient_items(bodies)


def by_type(items: Column) -> Column:
    """Map of type to a JSON array text of its items."""

    def grouped(rows: Column) -> Column:
        kinds = F.array_sort(F.array_distinct(F.transform(rows, lambda r: r["key"])))
        return F.map_from_entries(
            F.transform(
                kinds,
                lambda k: F.struct(
                    k.alias("key"),
                    F.concat(
                        F.lit("["),
                        F.array_join(
                            F.transform(F.filter(rows, lambda r: r["key"] == k), lambda r: r["value"]), ","
                        ),
                        F.lit("]"),
                    ).alias("value"),
                ),
            )
        )

    return let(items, grouped)


def microdata_items(dom: ColumnOrName) -> Column:
    """Array of type/JSON structs, one per typed scope, all properties below it flattened."""
    scopes = D.select(dom, "[itemscope][itemtype]")

    def value(node: Column) -> Column:
        return F.coalesce(
            D.attr(node, "content"), D.attr(node, "href"), D.attr(node, "src"), D.text(dom, node)
        )

    def item(scope: Column) -> Column:
        props = F.filter(D.descendants(dom, scope), lambda n: D.attr(n, "itemprop").isNotNull())
        pairs = F.transform(
            props, lambda n: F.struct(D.attr(n, "itemprop").alias("key"), value(n).alias("value"))
        )
        return F.struct(
            F.substring_index(D.attr(scope, "itemtype"), "/", -1).alias("key"),
            F.to_json(last_wins(pairs)).alias("value"),
        )

    return F.transform(scopes, item)


def jsonld(html: ColumnOrName) -> Column:
    return by_type(jsonld_items(html))


def first_type_jsonld(html: ColumnOrName) -> Column:
    """Lenient form: comments and trailing commas pass, the last item of a type is kept bare."""
    return last_wins(jsonld_items(html, strict=False))


def microdata(dom: ColumnOrName) -> Column:
    return by_type(microdata_items(dom))


def schema_map(html: ColumnOrName, dom: ColumnOrName) -> Column:
    """JSON-LD and microdata items by type, JSON-LD first; an empty map if there are none."""
    return by_type(F.concat(jsonld_items(html), microdata_items(dom)))
