"""Typed fields from messy page text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.functions import tags
from pageloom.functions.columns import ColumnOrName, col, let, strip

# Words for yes and no.
TRUE_WORDS = ("true", "yes", "1", "on")
FALSE_WORDS = ("false", "no", "0", "off")

# Currency marks and codes.
CURRENCY_MARKS = (("€", "EUR"), ("£", "GBP"), ("¥", "JPY"), ("₹", "INR"), ("US$", "USD"), ("$", "USD"), ("¢", "USD"), ("kr", "SEK"))
CURRENCY_CODES = ("EUR", "USD", "GBP", "JPY", "INR", "SEK", "NOK", "DKK", "CHF", "PLN", "CAD", "AUD")

# Unit name, base unit, factor to the base unit.
UNITS = (
    ("kg", "g", 1000.0),
    ("g", "g", 1.0),
    ("mg", "g", 0.001),
    ("lb", "g", 453.592),
    ("lbs", "g", 453.592),
    ("oz", "g", 28.3495),
    ("l", "ml", 1000.0),
    ("liter", "ml", 1000.0),
    ("litre", "ml", 1000.0),
    ("ltr", "ml", 1000.0),
    ("dl", "ml", 100.0),
    ("cl", "ml", 10.0),
    ("ml", "ml", 1.0),
    ("pcs", "count", 1.0),
    ("pack", "count", 1.0),
    ("count", "count", 1.0),
    ("kpl", "count", 1.0),
)
_UNIT_WORDS = "|".join(sorted((u[0] for u in UNITS), key=len, reverse=True))


def to_decimal(text: ColumnOrName) -> Column:
    """First number of a text with its sign, as a double."""
    return F.regexp_extract(col(text), r"(-?[0-9]+(?:\.[0-9]+)?|-?\.[0-9]+)", 1).try_cast("double")


def to_integer(text: ColumnOrName) -> Column:
    return F.regexp_extract(col(text), r"(-?[0-9]+)", 1).try_cast("bigint")


def to_boolean(text: ColumnOrName) -> Column:
    word = F.lower(strip(col(text)))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def trim(text: ColumnOrName) -> Column:
    return strip(col(text))


def strip_html(text: ColumnOrName) -> Column:
    return F.regexp_replace(col(text), "<[^>]*>", "")


def clean_text(text: ColumnOrName) -> Column:
    """Without tags, entities decoded, whitespace collapsed."""
    return strip(F.regexp_replace(tags.decode_entities(strip_html(text)), r"\s+", " "))


def parse_price(text: ColumnOrName) -> Column:
    """Amount of a price text with either decimal mark; NULL without digits.

    The last comma or point is the decimal mark when one or two digits follow it.
    """
    raw = F.regexp_extract(col(text), r"(-?[0-9][0-9.,  ']*)", 1)
    bare = F.regexp_replace(raw, r"[  ']|[.,]+\s*$", "")
    fraction = F.regexp_extract(bare, r"[.,]([0-9]{1,2})$", 1)
    whole = F.regexp_replace(F.regexp_replace(bare, r"[.,][0-9]{1,2}$", ""), "[.,]", "")
    amount = F.when(fraction == "", whole).otherwise(F.concat(whole, F.lit("."), fraction))
    cents = F.contains(col(text), F.lit("¢"))
    value = amount.try_cast("decimal(18,2)")
    return F.when(cents, (value / 100).cast("decimal(18,2)")).otherwise(value)


def parse_currency(text: ColumnOrName) -> Column:
    """ISO code of a currency code or mark in a price text."""
    text = col(text)
    result = F.lit(None).cast("string")
    for mark, code in reversed(CURRENCY_MARKS):
        result = F.when(F.contains(text, F.lit(mark)), code).otherwise(result)
    code = F.regexp_extract(F.upper(text), rf"\b({'|'.join(CURRENCY_CODES)})\b", 1)
    return F.coalesce(F.nullif(code, F.lit("")), result)


def price(text: ColumnOrName) -> Column:
    """``struct(amount, currency, is_zero)``; a zero price is flagged, not kept."""
    amount = parse_price(text)
    return F.struct(
        F.when(amount != 0, amount).alias("amount"),
        parse_currency(text).alias("currency"),
        F.coalesce(amount == 0, F.lit(False)).alias("is_zero"),
    )


def quantity(text: ColumnOrName) -> Column:
    """``struct(packs, size, unit, base_unit, total)`` of ``6 x 330 ml`` or ``500g``.

    ``total`` is in the base unit; without a known unit the whole struct is NULL.
    """
    low = F.lower(col(text))
    number = r"([0-9]+(?:[.,][0-9]+)?)"
    size_text = F.regexp_extract(low, rf"{number}\s*({_UNIT_WORDS})\b", 1)
    unit = F.regexp_extract(low, rf"{number}\s*({_UNIT_WORDS})\b", 2)
    packs_text = F.regexp_extract(low, rf"([0-9]+)\s*[x×]\s*{number}\s*(?:{_UNIT_WORDS})\b", 1)
    size = F.replace(size_text, F.lit(","), F.lit(".")).try_cast("double")
    packs = F.coalesce(packs_text.try_cast("int"), F.lit(1))
    base = F.create_map(*[F.lit(x) for name, base_unit, _ in UNITS for x in (name, base_unit)])
    factor = F.create_map(*[F.lit(x) for name, _, f in UNITS for x in (name, f)])
    whole = F.struct(
        packs.alias("packs"),
        size.alias("size"),
        unit.alias("unit"),
        F.try_element_at(base, unit).alias("base_unit"),
        (packs * size * F.try_element_at(factor, unit)).alias("total"),
    )
    return F.when(unit != "", whole)


def unit_price(amount: ColumnOrName, total: ColumnOrName, per: float = 1000.0) -> Column:
    """Price per ``per`` base units."""
    total = col(total)
    return F.when(total > 0, col(amount).cast("double") * per / total)


def stock_status(text: ColumnOrName) -> Column:
    """Availability of a schema.org address or of page text; sold out comes first."""
    low = F.lower(F.coalesce(col(text), F.lit("")))
    return (
        F.when(low.rlike("discontinued"), "DISCONTINUED")
        .when(low.rlike("sold ?out|out ?of ?stock|unavailable|ausverkauft|loppu"), "OUT_OF_STOCK")
        .when(low.rlike("pre-?order"), "PRE_ORDER")
        .when(low.rlike("in ?stock|low stock|limited|only [0-9]+ left|add to cart|instoreonly|available"), "IN_STOCK")
        .otherwise("OUT_OF_STOCK")
    )


def extract_number(text: ColumnOrName) -> Column:
    return to_decimal(F.replace(col(text), F.lit(","), F.lit(".")))


# Date spellings that are tried in turn.
DATE_FORMATS = ("yyyy-MM-dd", "d.M.yyyy", "d/M/yyyy", "d MMM yyyy", "MMM d, yyyy")


def parse_date(text: ColumnOrName) -> Column:
    text = strip(col(text))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS]).cast("date")


def join_array(values: ColumnOrName, separator: str = ", ") -> Column:
    return F.array_join(col(values), separator)


def first_group(text: ColumnOrName, pattern: str) -> Column:
    """First capture group of a pattern, NULL where it is not found."""
    return let(F.regexp_extract(col(text), pattern, 1), lambda g: F.nullif(g, F.lit("")))


TRANSFORMS = {
    "trim": trim,
    "lowercase": lambda c: F.lower(col(c)),
    "uppercase": lambda c: F.upper(col(c)),
    "strip_html": strip_html,
    "clean_text": clean_text,
    "parse_price": parse_price,
    "parse_currency": parse_currency,
    "parse_quantity": lambda c: quantity(c)["size"],
    "parse_unit": lambda c: quantity(c)["unit"],
    "normalize_quantity": lambda c: quantity(c)["total"],
    "parse_stock": lambda c: stock_status(c) == "IN_STOCK",
    "parse_date": parse_date,
    "extract_number": extract_number,
    "join_array": join_array,
}
TYPES = {
    "VARCHAR": lambda c: c,
    "DECIMAL": to_decimal,
    "DOUBLE": to_decimal,
    "FLOAT": to_decimal,
    "INTEGER": to_integer,
    "INT": to_integer,
    "BIGINT": to_integer,
    "BOOLEAN": to_boolean,
    "BOOL": to_boolean,
}
