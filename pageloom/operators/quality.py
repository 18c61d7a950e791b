"""Checks on extracted rows: validation, health per day, and matching of products."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.functions.columns import let, unpack
from pageloom.operators.running import lookup


def validate(rows: DataFrame, checks: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected rows with the names of the checks they failed."""
    failed = F.filter(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in checks.items()]),
        lambda n: n.isNotNull(),
    )
    checked = rows.withColumn("failed_checks", failed)
    return (
        checked.filter(F.size("failed_checks") == 0).drop("failed_checks"),
        checked.filter(F.size("failed_checks") > 0),
    )


def health(
    rows: DataFrame, source: str, day: Column, valid: Column, fields: Sequence[str], drop_below: float = 0.5
) -> DataFrame:
    """Rows, valid share, coverage per field, and whether throughput fell, per source and day.

    The previous day is looked up in the aggregate, which has one row per source and day.
    """
    daily = rows.groupBy(source, day.alias("day")).agg(
        F.count("*").alias("rows"),
        (F.count(F.when(valid, 1)) / F.count("*")).alias("valid_ratio"),
        *[(F.count(F.col(f)) / F.count("*")).alias(f"{f}_coverage") for f in fields],
    )
    before = F.lag("rows").over(Window.partitionBy(source).orderBy("day"))
    return daily.withColumn("previous_rows", before).withColumn(
        "dropped", F.coalesce(F.col("rows") < F.col("previous_rows") * drop_below, F.lit(False))
    )


def same_code(products: DataFrame, key: str, code: str) -> DataFrame:
    """Products sharing a trade item number get the smallest key as entity.

    Only numbers that occur more than once are joined back.
    """
    groups = products.filter(F.col(code).isNotNull()).groupBy(code).agg(
        F.min(key).alias("_first"), F.count("*").alias("_n")
    )
    shared = groups.filter("_n > 1").drop("_n")
    known = lookup(products.filter(F.col(code).isNotNull()), shared, code)
    alone = products.filter(F.col(code).isNull())
    joined = known.unionByName(alone, allowMissingColumns=True)
    return joined.withColumn("entity", F.coalesce("_first", key)).drop("_first")


def mark_copies(rows: DataFrame, key: str, fingerprint: str) -> DataFrame:
    """Number of rows with the same fingerprint, and whether a smaller key has it.

    Fingerprints that occur once, which are most, are not joined back.
    """
    counts = rows.groupBy(fingerprint).agg(F.count("*").alias("copies"), F.min(key).alias("_first"))
    joined = lookup(rows, counts.filter("copies > 1"), fingerprint)
    return joined.select(
        *rows.columns,
        F.coalesce("copies", F.lit(1)).alias("copies"),
        F.coalesce(F.col(key) != F.col("_first"), F.lit(False)).alias("duplicate"),
    )


def plain_name(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(name), r"[^a-z0-9]+", " "))


def _one_deleted(text: Column) -> Column:
    # Text itself and every text one character shorter.
    places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
    return F.array_distinct(
        F.concat(
            F.array(text),
            F.transform(places, lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text)))),
        )
    )


def near_names(products: DataFrame, block: Sequence[str], name: str) -> DataFrame:
    """Pairs of different names within a block that are one edit apart.

    Equal names are collapsed first, so copies cost nothing.  Two names one edit
    apart share a form with one character deleted; a form belongs to at most
    length times alphabet names, which bounds every join group.
    """
    names = products.select(*block, plain_name(F.col(name)).alias("name")).distinct()
    forms = unpack(names, [*block, "name"], _one_deleted(F.col("name")), "_i", "form").drop("_i")
    left = forms.withColumnRenamed("name", "name_a")
    right = forms.withColumnRenamed("name", "name_b")
    pairs = left.join(right, [*block, "form"]).filter("name_a < name_b")
    return pairs.filter(F.levenshtein("name_a", "name_b") <= 1).select(*block, "name_a", "name_b").distinct()


def _edits(length: Column) -> Column:
    """The most edits of a pair whose longer name has this length: fewer than a tenth of it."""
    return F.floor((length - 1) / 10).cast("int")


#: Characters of a gram; an edit destroys as many grams at most.
_GRAM = 3


def _most_edits(length: Column) -> Column:
    """The most edits of a pair whose shorter name has this length: the longer one has a ninth more at most."""
    return _edits(length + F.floor(length / 9).cast("int") + 1)


def _grams(name: Column) -> Column:
    """All grams of a name; equal ones are told apart by a number."""
    grams = F.transform(F.sequence(F.lit(1), F.length(name) - (_GRAM - 1)), lambda i: F.substring(name, i, F.lit(_GRAM)))
    return let(
        F.array_sort(grams),
        lambda every: F.transform(every, lambda g, i: F.struct(g.alias("gram"), (i + 1 - F.array_position(every, g)).cast("int").alias("nth"))),
    )


def candidate_names(names: DataFrame, block: Sequence[str]) -> DataFrame:
    """Pairs (``name_a`` < ``name_b``) of a block that share one of their rarest grams and may be similar by length.

    Grams are counted in each block and stand in order of frequency.  With k edits at most
    two names differ in 3 k of their grams, so the first 3 k + 1 of both have one in common.
    What many names of a block have in common is not among the first ones of a name that has
    3 k + 1 grams of its own.  With fewer (own parts of less than about a third of the name),
    common grams come in and more pairs are compared; none is lost.
    """
    placed = names.select(*block, "name", F.explode(_grams(F.col("name"))).alias("token"))
    counts = placed.groupBy(*block, "token").agg(F.count("*").alias("n"))
    ranked = placed.join(counts, [*block, "token"]).groupBy(*block, "name").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("all"))
    first = F.slice("all", F.lit(1), _GRAM * _most_edits(F.length("name")) + 1)
    keyed = ranked.select(*block, "name", F.explode(F.transform(first, lambda t: t["token"])).alias("token"))
    other = keyed.withColumnRenamed("name", "name_b")
    met = keyed.withColumnRenamed("name", "name_a").join(other, [*block, "token"])
    a, b = F.length("name_a"), F.length("name_b")
    close = F.abs(a - b) <= _edits(F.greatest(a, b))
    return met.filter((F.col("name_a") < F.col("name_b")) & close).select(*block, "name_a", "name_b").distinct()


def similar_names(products: DataFrame, block: Sequence[str], name: str) -> DataFrame:
    """Pairs of different names within a block with a similarity above 90 %: edits under a tenth of the longer name.

    ``block`` are the columns that must be equal, as brand and weight; null is equal to
    nothing.  Equal names are collapsed first.  Pairs that share a rare part (see
    :func:`candidate_names`) are compared in whole.
    """
    names = products.select(*block, plain_name(F.col(name)).alias("name")).dropna().distinct()
    pairs = candidate_names(names.filter(F.length("name") >= 10), block)
    longest = F.greatest(F.length("name_a"), F.length("name_b"))
    return pairs.filter(F.levenshtein("name_a", "name_b") * 10 < longest)
