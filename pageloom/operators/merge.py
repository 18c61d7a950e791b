"""Merge of a query result into a keyed snapshot.

One full outer join decides per row what happens; the outcome is a new snapshot
and a one-row count.  Conditions and values are SQL texts or Columns that name
the two sides ``t`` and ``s``.

Kept on purpose: every clause list is honoured in order, a composite key works
like a single one, a row limit holds for changes caused by source rows only, and
rows missing from the source are judged by all source keys, also with a limit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.operators.running import nth_in_order, total_order
from pageloom.session import cut_lineage

Expr = Column | str
UPDATE, DELETE, INSERT = "update", "delete", "insert"
MATCHED, NEW, GONE = "matched", "not_matched", "not_matched_by_source"


@dataclass(frozen=True)
class Clause:
    when: str
    action: str
    condition: Expr | None = None
    # Column to value; None stands for "by name".
    values: Mapping[str, Expr] | None = None


def when_matched_update(condition: Expr | None = None, values: Mapping[str, Expr] | None = None) -> Clause:
    return Clause(MATCHED, UPDATE, condition, values)


def when_matched_delete(condition: Expr | None = None) -> Clause:
    return Clause(MATCHED, DELETE, condition)


def when_not_matched_insert(condition: Expr | None = None, values: Mapping[str, Expr] | None = None) -> Clause:
    return Clause(NEW, INSERT, condition, values)


def when_not_matched_by_source_update(values: Mapping[str, Expr], condition: Expr | None = None) -> Clause:
    return Clause(GONE, UPDATE, condition, values)


def when_not_matched_by_source_delete(condition: Expr | None = None) -> Clause:
    return Clause(GONE, DELETE, condition)


def _column(value: Expr) -> Column:
    return F.expr(value) if isinstance(value, str) else value


@dataclass
class Merge:
    """Result of :func:`merge`; both parts are lazy."""

    columns: Sequence[str]
    tagged: DataFrame = field(repr=False)

    @property
    def snapshot(self) -> DataFrame:
        kept = self.tagged.filter("_action is null or _action not in ('delete', 'skip')")
        return kept.select(*self.columns)

    @property
    def counts(self) -> DataFrame:
        def rows(action: str, name: str) -> Column:
            return F.count(F.when(F.col("_action") == action, 1)).alias(name)

        return self.tagged.agg(
            rows(INSERT, "rows_inserted"), rows(UPDATE, "rows_updated"), rows(DELETE, "rows_deleted")
        )


def one_row_per_key(source: DataFrame, on: Sequence[str], order_by: str | None) -> DataFrame:
    """Last row per key by ``order_by``; without it a repeated key is an error.

    Partial aggregation collapses copies of a key before the shuffle, and the
    result is already distributed the way the merge join needs it.
    """
    row = F.struct(*[F.col(c) for c in source.columns])
    if order_by:
        picked = F.max_by(row, total_order(source, order_by))
    else:
        text = F.concat(F.lit("merge source repeats a key: "), F.to_json(F.struct(*on)))
        picked = F.when(F.count("*") > 1, F.raise_error(text)).otherwise(F.any_value(row))
    grouped = source.groupBy(*on).agg(picked.alias("_row"))
    return grouped.select(*on, *[F.col(f"_row.{c}").alias(c) for c in source.columns if c not in on])


def merge(
    target: DataFrame,
    source: DataFrame,
    on: str | Sequence[str],
    clauses: Sequence[Clause],
    order_by: str | None = None,
    limit: int | None = None,
    defaults: Mapping[str, Expr] | None = None,
) -> Merge:
    """Apply merge clauses; the first clause whose condition holds decides.

    ``limit`` stops after that many changed rows in the order of ``order_by`` and
    needs it; the join is then run ahead and kept, and the last change is found by ranges.  ``defaults`` fill columns an insert by name does not provide.
    """
    on = [on] if isinstance(on, str) else list(on)
    defaults = defaults or {}
    if limit is not None and order_by is None:
        raise ValueError("a merge limit needs order_by")
    known = F.lit(True)
    for key in on:
        known = known & F.col(key).isNotNull()

    source = source.withColumn("_s", F.lit(True))
    t = target.withColumn("_t", F.lit(True)).alias("t")
    # The aggregate below is laid out by the join keys, so the join shuffles the source no more.
    s = one_row_per_key(source.filter(known), on, order_by).alias("s")
    joined = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in on], "full")
    # A NULL key equals nothing, so such source rows can only be inserted.
    loose = source.filter(~known).alias("s").join(t.filter(F.lit(False)), F.lit(False), "left")

    in_both = F.col("t._t").isNotNull() & F.col("s._s").isNotNull()
    state = {
        MATCHED: in_both,
        NEW: F.col("t._t").isNull(),
        GONE: F.col("s._s").isNull(),
    }
    choice = F.lit(None).cast("int")
    for number in range(len(clauses) - 1, -1, -1):
        clause = clauses[number]
        holds = state[clause.when]
        if clause.condition is not None:
            holds = holds & F.coalesce(_column(clause.condition), F.lit(False))
        choice = F.when(holds, number).otherwise(choice)

    def value_of(name: str, clause: Clause) -> Column:
        current = F.col(f"t.{name}")
        if clause.values is not None:
            given = clause.values.get(name)
            if given is not None:
                return _column(given)
            missing = F.lit(None)
        elif name in source.columns and (clause.action == INSERT or name not in on):
            return F.col(f"s.{name}")
        else:
            missing = F.lit(None)
        if clause.action == INSERT:
            return _column(defaults[name]) if name in defaults else missing
        return current

    actions = F.array(*[F.lit(c.action) for c in clauses])
    action = F.get(actions, F.col("_clause"))
    if any(c.when == NEW for c in clauses):
        action = F.when(state[NEW] & F.col("_clause").isNull(), "skip").otherwise(action)
    else:
        action = F.when(state[NEW], "skip").otherwise(action)

    columns = []
    for name in target.columns:
        kind = target.schema[name].dataType
        value = F.col(f"t.{name}")
        for number in range(len(clauses) - 1, -1, -1):
            if clauses[number].action != DELETE:
                new = value_of(name, clauses[number]).cast(kind)
                value = F.when(F.col("_clause") == number, new).otherwise(value)
        columns.append(value.alias(name))

    def decided(*extra: Column) -> DataFrame:
        outcome = [*columns, action.alias("_action"), *extra]
        return (
            joined.withColumn("_clause", choice)
            .select(*outcome)
            .unionByName(loose.withColumn("_clause", choice).select(*outcome))
        )

    if limit is None:
        return Merge(target.columns, decided())

    # The first ``limit`` changes in source order; later ones leave the target as it was.
    tagged = decided(
        F.struct(*[F.col(f"t.{c}").alias(c) for c in target.columns]).alias("_old"),
        F.col("t._t").isNotNull().alias("_had"),
        F.col(f"s.{order_by}").alias("_order"),
        F.col("s._s").isNotNull().alias("_from_source"),
        *[F.coalesce(F.col(f"s.{k}"), F.col(f"t.{k}")).alias(f"_k{i}") for i, k in enumerate(on)],
    )
    marks = ["_order", *[f"_k{i}" for i in range(len(on))]]
    # The join runs once: what it gives is kept, and both the edge and the rows are read from that.
    tagged = cut_lineage(tagged)
    changed = tagged.filter("_from_source and _action in ('insert', 'update', 'delete')")
    if limit <= 0:
        beyond = F.col("_from_source")
    else:
        # Only the last accepted change matters: everything up to it is in.
        edge = nth_in_order(changed, marks, limit)
        beyond = F.lit(False)
        if edge is not None:
            last = F.struct(*[F.lit(edge[m]).cast(changed.schema[m].dataType).alias(m) for m in marks])
            beyond = F.col("_from_source") & F.coalesce(F.struct(*marks) > last, F.lit(False))
    cut = beyond & F.col("_action").isin(INSERT, UPDATE, DELETE)
    limited = tagged.select(
        *[F.when(cut, F.col(f"_old.{c}")).otherwise(F.col(c)).alias(c) for c in target.columns],
        F.when(cut & ~F.col("_had"), "skip").when(~cut, F.col("_action")).alias("_action"),
    )
    return Merge(target.columns, limited)


def without_fresh(
    source: DataFrame, target: DataFrame, on: str | Sequence[str], stale: Expr
) -> DataFrame:
    """Source keys worth the page lookup: new ones and those with a stale target row.

    Catalyst cannot derive this from a merge, so it runs ahead of the store join.
    """
    on = [on] if isinstance(on, str) else list(on)
    fresh = target.alias("t").filter(~F.coalesce(_column(stale), F.lit(False))).select(*on)
    return source.join(fresh, on, "left_anti")
