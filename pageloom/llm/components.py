"""Connected components of an edge table by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.session import cut_lineage, release


def components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """(node, comp) of every node of ``edges`` (a, b): ``comp`` is the least node of its component.

    A round gives each node the least label among its neighbours and then the label of
    that label, so long chains shorten by half.  A round's table is kept in the shared
    folder until the next one is there.  Labels meet neighbours by joins and are combined before each shuffle.
    ``edges`` is worked out once for both directions, as a second turn may give another choice of
    edges; ``most`` is how many there are at most, where that is known.
    """
    turns = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = edges.filter("a <> b").select(F.explode(turns).alias("e")).select("e.a", "e.b")
    both = cut_lineage(both.distinct(), most and 2 * most)
    rows = both.count()
    labels = last = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), rows)
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        lower = labels.join(seen, "node").select("node", "comp", F.least("comp", "near").alias("low"))
        roots = labels.select(F.col("node").alias("low"), F.col("comp").alias("root"))
        jumped = cut_lineage(lower.join(roots, "low", "left").select("node", "comp", F.least("low", "root").alias("next")), rows)
        changed = jumped.filter("next <> comp").limit(1).count()
        release(last)
        labels, last = jumped.select("node", F.col("next").alias("comp")), jumped
        if not changed:
            release(both)
            return labels
