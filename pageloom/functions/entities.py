"""Character references of HTML, as column expressions and for one Python string.

Names come from the standard table that Python carries.  In an attribute a name without
a semicolon counts only if no letter, digit or ``=`` follows, so ``?a=1&copy=2`` stays.
"""

from __future__ import annotations

import json
import re
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.functions.columns import ColumnOrName, col, let

# The names most pages use; they are looked for before the whole table.
COMMON = ("lt;", "gt;", "quot;", "apos;", "nbsp;", "copy;", "middot;", "amp;")
# Names that count without a semicolon.
_BARE = sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True)
_OLD_CODES = [bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(0x80, 0xA0)]
_WRONG = "�"
_REFERENCE = r"&#[0-9]++;?|&#[xX][0-9A-Fa-f]++;?|&[A-Za-z][A-Za-z0-9]*+[;=]?"


def _code_point(code: Column) -> Column:
    """The character of a number."""
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    old = F.get(F.array(*[F.lit(c) for c in _OLD_CODES]), (code - 0x80).cast("int"))
    return (
        F.when((code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), _WRONG)
        .when(code.between(0x80, 0x9F), old)
        .otherwise(plain)
    )


def _number(reference: Column) -> Column:
    is_hex = reference.rlike("^&#[xX]")
    digits = F.regexp_extract(reference, "^&#[xX]?0*([0-9A-Fa-f]*)", 1)
    code = F.when(is_hex, F.conv(F.concat(F.lit("0"), digits), 16, 10)).otherwise(F.concat(F.lit("0"), digits))
    return let(F.when(F.length(digits) > 7, 0x110000).otherwise(code.cast("long")), _code_point)


def _named(reference: Column, in_attribute: bool) -> Column:
    name = F.regexp_replace(F.substring(reference, 2, 1 << 20), "=$", "")
    common = F.create_map(*[F.lit(x) for n in COMMON for x in (n, html5[n])])
    table = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")
    ends = F.endswith(reference, F.lit("="))
    whole = F.coalesce(F.try_element_at(common, name), F.try_element_at(table, name))
    if in_attribute:
        return F.when(ends, reference).otherwise(F.coalesce(whole, reference))
    known = F.when(ends, F.concat(F.try_element_at(table, name), F.lit("="))).otherwise(whole)
    old = F.regexp_extract(reference, f"^&({'|'.join(_BARE)})", 1)
    front = F.when(old != "", F.concat(F.try_element_at(table, old), F.substring(reference, F.length(old) + 2, F.length(reference))))
    return F.coalesce(known, front, reference)


def decoded(text: ColumnOrName, in_attribute: bool = False) -> Column:
    """Text with its character references replaced."""
    text = col(text)

    def one(part: Column) -> Column:
        return (
            F.when(part.rlike("^&#[0-9xX]"), _number(part))
            .when(part.rlike("^&[A-Za-z]"), _named(part, in_attribute))
            .otherwise(part)
        )

    parts = F.regexp_extract_all(text, F.lit(rf"(?s){_REFERENCE}|&|[^&]++"), F.lit(0))
    every = F.array_join(F.transform(parts, one), "")
    # Most texts have no reference but that of the ampersand.
    rare = text.rlike("&(?!amp;)[#A-Za-z]")
    return F.when(~F.contains(text, F.lit("&")), text).when(rare, every).otherwise(F.replace(text, F.lit("&amp;"), F.lit("&")))


_PATTERN = re.compile(_REFERENCE)


def _decoded_one(found: re.Match) -> str:
    reference = found[0]
    if reference[1] == "#":
        is_hex = reference[2] in "xX"
        digits = reference[3 if is_hex else 2 :].rstrip(";").lstrip("0")
        code = 0x110000 if len(digits) > 7 else int(digits or "0", 16 if is_hex else 10)
        if code == 0 or code > 0x10FFFF or 0xD800 <= code <= 0xDFFF:
            return _WRONG
        return _OLD_CODES[code - 0x80] if 0x80 <= code <= 0x9F else chr(code)
    return reference if reference[-1] == "=" else html5.get(reference[1:], reference)


def decoded_attribute(value: str) -> str:
    """:func:`decoded` of one attribute value."""
    return _PATTERN.sub(_decoded_one, value) if "&" in value else value
