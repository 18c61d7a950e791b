"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Every source gets a target in words (``source_targets``).
2. A document's place in its source is a hash.  The source's whole passes, and a
   last pass up to a cut in hash order, reach the target; the cut is found by counts
   over 1,024 bins of the hash, then over the bins of the bin it falls into.
3. A source is cut into blocks of equal hash ranges.  A tree splits the numbers of
   blocks of all sources over the output shards: each node draws its left half from
   a multivariate hypergeometric distribution, seeded by the node's place.  A shard
   then owns a run of places in every source's permuted blocks, disjoint from all
   other shards.
4. Documents meet the shard of their block in one join on (source, block), and are
   shuffled inside the shard by another hash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pageloom.llm.text import SPACED_WORD
from pageloom.session import cut_lineage

#: Sources are a small dimension; more than these are an error, not a truncation.
MAX_SOURCES = 100_000
BIN_BITS = 10
HASH_BITS = 60


def cycled_weight(rank: int) -> float:
    return (5.0, 2.0, 1.0)[rank % 3]


def source_targets(sizes: Sequence[int], weights: Sequence[float], share: float, most: float) -> list[float]:
    """Shares of ``share`` times all sizes by weight; none above ``most`` times its size.

    What is cut off is shared again by weight among the others until none is above.
    """
    targets = [0.0] * len(sizes)
    free = [i for i in range(len(sizes)) if weights[i] > 0 and sizes[i] > 0]
    rest = share * sum(sizes)
    while free:
        unit = rest / sum(weights[i] for i in free)
        above = [i for i in free if unit * weights[i] >= most * sizes[i]]
        if not above:
            for i in free:
                targets[i] = unit * weights[i]
            break
        for i in above:
            targets[i] = most * sizes[i]
            rest -= targets[i]
        free = [i for i in free if targets[i] == 0.0]
    return targets


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(SPACED_WORD)), F.lit(0)).cast("long")


def place(seed: int, *columns: Column | str) -> Column:
    """A hash of ``HASH_BITS`` bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 64 - HASH_BITS)


@dataclass(frozen=True)
class Share:
    """What the mix takes of one source: whole passes, and a pass of places below ``cut``."""

    source: str | None
    rank: int
    size: int
    target: float
    passes: int
    cut: int
    blocks: int

    @property
    def last_blocks(self) -> int:
        """Blocks of the pass that is cut off."""
        return min(self.blocks, int(self.cut / (1 << HASH_BITS) * self.blocks) + 1) if self.cut else 0

    @property
    def quota(self) -> int:
        return self.passes * self.blocks + self.last_blocks


def _cuts(items: DataFrame, wanted: dict[int, float], ranks: DataFrame) -> dict[int, int]:
    """For each source the place below which its documents have about the wanted words.

    Each round looks at one bin of every open source, split into 1,024 bins; it
    sends at most one row per source to the driver.
    """
    spark = items.sparkSession
    found: dict[int, int] = {}
    state = {rank: (0, want) for rank, want in wanted.items() if want > 0}  # start of the bin, words wanted in it
    shift = HASH_BITS
    rows = items.join(F.broadcast(ranks), F.col("source").eqNullSafe(F.col("of_source"))).select("rank", "size", "u")
    while state and shift > 0:
        shift -= BIN_BITS
        open_bins = spark.createDataFrame(
            [(rank, start >> (shift + BIN_BITS), float(want)) for rank, (start, want) in state.items()],
            "rank int, bin long, want double",
        )
        sums = (
            rows.join(F.broadcast(open_bins), "rank")
            .filter(F.shiftright("u", shift + BIN_BITS) == F.col("bin"))
            .groupBy("rank", "want", F.shiftright("u", shift).alias("part"))
            .agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
        )
        # Parts of a bin in order: at most 1,024 rows for each source.
        so_far = Window.partitionBy("rank").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
        ends = sums.withColumn("upto", F.sum("words").over(so_far))
        hit = (
            ends.filter(F.col("upto") >= F.col("want"))
            .groupBy("rank")
            .agg(F.min(F.struct("part", "upto", "words", "docs", "want")).alias("hit"))
            .select("rank", "hit.*")
            .collect()
        )
        reached = {r["rank"]: r for r in hit}
        for rank in list(state):
            row = reached.get(rank)
            if row is None:  # all of the bin
                found[rank] = (state[rank][0] >> (shift + BIN_BITS)) + 1 << (shift + BIN_BITS)
                del state[rank]
                continue
            left = row["want"] - (row["upto"] - row["words"])
            if row["docs"] == 1 or shift == 0:
                part = row["part"] + (1 if 2 * left >= row["words"] else 0)
                found[rank] = part << shift
                del state[rank]
            else:
                state[rank] = (row["part"] << shift, left)
    return found


def source_shares(
    items: DataFrame,
    share: float,
    most: int,
    weight: Callable[[int], float],
    block_words: int,
) -> list[Share]:
    """Targets and cuts of all sources of ``items`` (source, size, u)."""
    totals = items.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: map them to fewer mixture components first")
    totals.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [int(r["size"] or 0) for r in totals]
    targets = source_targets(sizes, [weight(k) for k in range(len(totals))], share, most)
    passes = [min(most, int(t // s)) if s else 0 for t, s in zip(targets, sizes)]
    wanted = {k: t - p * s for k, (t, p, s) in enumerate(zip(targets, passes, sizes)) if s and t - p * s >= 0.5}
    ranks = items.sparkSession.createDataFrame(
        [(r["source"], k) for k, r in enumerate(totals)], "of_source string, rank int"
    )
    cuts = _cuts(items, wanted, ranks) if wanted else {}
    return [
        Share(r["source"], k, sizes[k], targets[k], passes[k], cuts.get(k, 0), max(1, round(sizes[k] / block_words)))
        for k, r in enumerate(totals)
    ]


def split_quotas(quotas: np.ndarray, shards: int, seed: int, low: int, high: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Shards ``low`` to ``high`` of the tree: shard, its first place and its number of blocks per source.

    The node over shards [a, b) gives its left half so many blocks as that half's
    part of the shards, drawn without replacement over all sources.  Its random
    numbers depend on the seed and on a and b only, so any task can walk to its leaves.
    """
    stack = [(0, shards, np.zeros(len(quotas), np.int64), quotas.astype(np.int64))]
    while stack:
        a, b, first, counts = stack.pop()
        if b <= low or a >= high:
            continue
        if b - a == 1:
            yield a, first, counts
            continue
        middle = (a + b) // 2
        take = int(counts.sum()) * (middle - a) // (b - a)
        dice = np.random.Generator(np.random.PCG64([seed, a, b]))
        left = dice.multivariate_hypergeometric(counts, take, method="marginals")
        stack.append((middle, b, first + left, counts - left))
        stack.append((a, middle, first, left))


def _stride(n: int, seed: int) -> int:
    """A step that visits all of n places."""
    step = max(1, int(n * 0.6180339887) + seed % 7)
    while math.gcd(step, n) != 1:
        step += 1
    return step


def block_shards(spark: SparkSession, shares: Sequence[Share], shards: int, seed: int, leaves: int = 64) -> DataFrame:
    """(rank, block, owners): for each block that is drawn, the pass and shard of each draw."""
    quotas = np.array([s.quota for s in shares], dtype=np.int64)
    blocks = np.array([s.blocks for s in shares], dtype=np.int64)
    strides = np.array([_stride(int(q), seed) if q else 1 for q in quotas], dtype=np.int64)

    def draw(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in groups:
            for group in batch["id"]:
                for shard, first, counts in split_quotas(quotas, shards, seed, group * leaves, (group + 1) * leaves):
                    ranks = np.repeat(np.arange(len(quotas)), counts)
                    if not len(ranks):
                        continue
                    within = np.arange(len(ranks)) - np.repeat(np.cumsum(counts) - counts, counts)
                    at = np.repeat(first, counts) + within
                    item = at * strides[ranks] % quotas[ranks]
                    yield pd.DataFrame(
                        {
                            "rank": ranks.astype("int32"),
                            "block": item % blocks[ranks],
                            "pass": (item // blocks[ranks]).astype("int32"),
                            "shard": np.full(len(ranks), shard, dtype="int32"),
                        }
                    )

    groups = spark.range(0, -(-shards // leaves), 1, max(1, min(-(-shards // leaves), 200)))
    drawn = groups.mapInPandas(draw, "rank int, block long, pass int, shard int")
    return drawn.groupBy("rank", "block").agg(F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("owners"))


_DRAWS = "array<struct<pass:int,shard:int>>"


def mix(
    docs: DataFrame,
    share: float = 1.5,
    most: int = 2,
    weight: Callable[[int], float] = cycled_weight,
    text: str = "text",
    source: str = "source",
    id_column: str = "doc_id",
    block_words: int = 50_000,
    shard_words: int = 500_000,
    seed: int = 11,
    whole_rows: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: id, ``source``, ``size``, ``source_size``, ``target``, ``taken``, ``draws``, ``place``.

    ``draws`` lists pass and shard of each time the document is taken (at most ``most``
    times), ``taken`` is its words times their number.  Sources in code point order,
    null last, get ``weight(rank)``.  With ``whole_rows`` all columns of ``docs`` stay,
    and those named like a result are replaced.

    A source's taken words differ from its target by less than its document at the cut
    (equal rows stand at one place and are taken together).  A null text has no words;
    empty texts are taken like others and add nothing.  Null ids and repeated rows are
    rows of their own.  An empty table gives an empty result.

    Work: texts are read once for a narrow table that is kept in the shared folder;
    sources are combined before every shuffle; the join with the blocks goes by
    (source, block), so a source with a third of all rows is spread over its blocks.
    Driver: one row per source, at most ``MAX_SOURCES``.
    """
    spark = docs.sparkSession
    u = place(seed, F.col(id_column), F.col(text))
    narrow = docs.select(
        F.col(id_column).alias("id"), F.col(source).alias("source"), word_count(text).alias("size"), u.alias("u")
    )
    narrow = cut_lineage(narrow)
    shares = source_shares(narrow, share, most, weight, block_words)
    known = spark.createDataFrame(
        [(s.source, s.rank, s.size, float(s.target), s.passes, s.cut, s.blocks) for s in shares],
        "of_source string, rank int, source_size long, target double, passes int, cut long, blocks long",
    )
    own = ["size", "source_size", "target", "taken", "draws", "place"]
    if whole_rows:
        kept = [c for c in docs.columns if c not in own]
        rows = docs.select(*[F.col(f"`{c}`") for c in kept], word_count(text).alias("size"), u.alias("u"))
    else:
        kept = [id_column, source]
        rows = narrow.select(F.col("id").alias(id_column), F.col("source").alias(source), "size", "u")
    rows = rows.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), "size", "u")
    rows = rows.join(F.broadcast(known), F.col(f"row.`{source}`").eqNullSafe(F.col("of_source")))
    shards = max(1, math.ceil(sum(s.target for s in shares) / shard_words))
    if shares:
        block = F.floor(F.col("u") / float(1 << HASH_BITS) * F.col("blocks")).cast("long")
        owners = block_shards(spark, shares, shards, seed)
        rows = rows.withColumn("block", F.least(block, F.col("blocks") - 1)).join(owners, ["rank", "block"], "left")
    else:
        rows = rows.withColumn("owners", F.lit(None).cast(_DRAWS))
    copies = F.col("passes") + (F.col("u") < F.col("cut")).cast("int")
    draws = F.filter(F.coalesce("owners", F.array().cast(_DRAWS)), lambda d: d["pass"] < copies)
    found = rows.select("row", "size", "source_size", "target", draws.alias("draws"), F.col("u").alias("place"))
    taken = (F.col("size") * F.size("draws")).alias("taken")
    return found.select("row.*", "size", "source_size", "target", taken, "draws", "place")


def shuffled_shards(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row of ``docs`` for each draw, with ``shard``, ``position`` in it and ``pass``.

    A shard holds about ``shard_words`` words in the order of a hash of document and pass.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "position", "pass")]
    drawn = mix(docs, whole_rows=True, **options).withColumn("draw", F.explode("draws"))
    drawn = drawn.select(*kept, F.col("draw.shard").alias("shard"), F.col("draw.pass").alias("pass"), F.xxhash64("place", "draw.pass").alias("_order"))
    at = F.row_number().over(Window.partitionBy("shard").orderBy("_order"))
    return drawn.withColumn("position", at).drop("_order")
