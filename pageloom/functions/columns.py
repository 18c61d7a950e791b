"""Small column helpers shared by the function modules."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

#: Bytes of page text that a Python function turns into objects at a time.
PIECE_BYTES = 1 << 20


def pieces(pages: pa.Array, limit: int = PIECE_BYTES) -> Iterator[pa.Array]:
    """Runs of rows of at most ``limit`` bytes, or single rows, whatever the size of the batch."""
    if len(pages) > 1 and pages.nbytes > limit:
        half = len(pages) // 2
        yield from pieces(pages.slice(0, half), limit)
        yield from pieces(pages.slice(half), limit)
    else:
        yield pages


def col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def extract(value: Column, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` that gives NULL where the pattern is not found."""
    return F.nullif(F.regexp_extract(value, pattern, group), F.lit(""))


def strip(value: Column) -> Column:
    """Trim every kind of whitespace, not only blanks."""
    return F.regexp_replace(value, r"^\s+|\s+$", "")


def first_of(values: Column) -> Column:
    """First array element, or NULL for an empty array."""
    return F.get(values, F.lit(0))


def unpack(rows: DataFrame, keep: list[str | Column], values: Column, place: str, item: str) -> DataFrame:
    """One row per array element with its place from 0; rows without elements drop out.

    A plain explode makes the optimizer test the array for elements ahead of it,
    which works out an expensive array twice.  The outer form does not.
    """
    opened = rows.select(*keep, F.posexplode_outer(values).alias(place, item))
    return opened.filter(F.col(place).isNotNull())


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``use``.

    A computed array named inside a lambda is worked out again for each element;
    binding it to a lambda variable of its own avoids that.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def last_wins(pairs: Column) -> Column:
    """Map of an array of key/value structs; the last pair of a key counts.

    Keys come out sorted, so a JSON text made from the map is stable.
    """
    placed = F.transform(pairs, lambda p, i: F.struct(p["key"].alias("key"), i.alias("i"), p["value"].alias("value")))

    def kept(rows: Column) -> Column:
        last = F.filter(
            rows, lambda r, i: F.coalesce(F.get(rows, i + 1)["key"] != r["key"], F.lit(True))
        )
        return F.map_from_entries(F.transform(last, lambda r: F.struct(r["key"], r["value"])))

    return let(F.array_sort(placed), kept)
