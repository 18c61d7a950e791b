"""Documents linked by the Jaccard similarity of their word n-grams, by token-combination prefixes.

Let a document have n n-grams (tokens) and let t be the number of them a similar
document may lack.  Tokens stand in one order for all documents: rare ones first, then
by class of frequency, by hash inside a class.  The prefix of a document grows until its
classes cover t + 1: a rare token covers one; of a class indexed by combinations of k
tokens, m tokens cover m - (k - 1).  Whatever t tokens of the prefix the other one
lacks, some class keeps k of them, so both hold one combination.  Combinations are
formed inside small subclasses (hash modulo a number that grows with the length),
which keeps their number in proportion to n.  Signatures of lengths that cannot be linked
are told apart.

Steps: count prefix tokens of all documents; index each distinct token set once; let big
groups meet one pivot each and merge what is linked; verify what is left in cells of
two small blocks; join components.  Every verification counts
whole token sets.  Tokens and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.components import components
from pageloom.llm.counting import Flags, and_end, value_counts
from pageloom.llm.text import FOLDED, mixed, pieces, span_hashes, window_hashes, words
from pageloom.session import cut_lineage, release

#: A token at the front of two or more documents is indexed by pairs, of more than this by triples.
#: Tokens of one document come first in the order, so that a prefix holds shared tokens only
#: where a document has few of its own.
VERY_FREQUENT = 4_096
#: Tokens of triples that tasks keep at hand; with more, the bound above rises until they fit.
MOST_VERY_FREQUENT = 1 << 20
#: Documents of a block; a cell verifies two blocks.
BLOCK = 192
#: Groups of so many members meet pivots before they are dealt into cells.
PIVOT_LEAST = 64


@dataclass(frozen=True)
class Rule:
    """``width`` words a token, linked from ``percent`` of the union on."""

    width: int = 3
    percent: int = 90

    def __post_init__(self) -> None:
        # Prefixes of pairs and triples reach far enough from here on only.
        if not 80 <= self.percent <= 100:
            raise ValueError("links are found from a similarity of 80 to 100 % on")

    def lacking(self, n: int) -> int:
        """How many of n tokens a linked document may lack."""
        return n - -(-n * self.percent // 100)

    def linked(self, shared: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """``sizes``: sum of both set sizes."""
        return 100 * shared >= self.percent * (sizes - shared)

    def step(self, n: int) -> int:
        """Lengths on a logarithmic scale: those of linked documents are at most one step apart."""
        return int(math.log(n) / (1.001 * math.log(100 / self.percent))) if self.percent < 100 else n

    def subclasses(self, slot: int) -> int:
        """A sixteenth of the shortest length that looks for others in a slot, so that prefixes stay short."""
        shortest = (100 / self.percent) ** (1.001 * (slot - 1)) if self.percent < 100 else slot - 1
        return max(1, int(shortest) // 16)


def token_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct tokens of each text; a text of fewer words has one token, without words none."""
    found = words(data, offsets)
    hashes = span_hashes(data, found.start, found.end, FOLDED)
    grams, at = window_hashes(hashes, found.first, width)
    bounds = np.searchsorted(at, found.first)
    out = []
    for k, n in enumerate(found.counts):
        if n >= width:
            own = np.sort(grams[bounds[k] : bounds[k + 1]])
            new = np.ones(len(own), dtype=bool)
            new[1:] = own[1:] != own[:-1]
            out.append(own[new])
        elif n:
            own = hashes[found.first[k] : found.first[k + 1]]
            out.append(window_hashes(own, np.array([0, n]), int(n))[0] ^ np.uint64(n))
        else:
            out.append(hashes[:0])
    return out


def set_digest(tokens: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    with np.errstate(over="ignore"):
        total = mixed(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens)) * np.uint64(0x9E3779B97F4A7C15)
    return int(mixed(np.array([total]))[0].view(np.int64))


@dataclass
class Frequent:
    """Classes of tokens: 1 if at the front of one document, else 2, or 3 for the ordered ``triples``.

    ``shared`` has a fixed size.  It lets some rare tokens pass as shared, the more the
    larger the corpus; they are then indexed by pairs like others.
    """

    shared: Flags
    triples: np.ndarray

    def classes(self, tokens: np.ndarray) -> np.ndarray:
        out = 1 + self.shared.has(tokens).astype(np.int8)
        maybe = np.flatnonzero(out == 2)
        if len(maybe) and len(self.triples):
            at = np.minimum(np.searchsorted(self.triples, tokens[maybe]), len(self.triples) - 1)
            out[maybe[self.triples[at] == tokens[maybe]]] = 3
        return out


def signatures(tokens: np.ndarray, frequent: Frequent, rule: Rule) -> np.ndarray:
    """The combinations a set is indexed by; none if only equal sets can be linked to it.

    Each is tied to a slot of lengths: a document looks in that of its own step and in
    the next one, and so meets linked ones, and no others, of all lengths.
    """
    n = len(tokens)
    need = rule.lacking(n) + 1
    if need == 1 and n * 100 // rule.percent == n:
        return tokens[:0]
    k = np.ones(n, np.int8)
    if not (frequent.classes(tokens[:need]) == 1).all():
        k = frequent.classes(tokens)
    rare = tokens[k == 1][:need]
    out = []
    for slot in (rule.step(n), rule.step(n) + 1):
        found = rare
        if len(rare) < need:
            found = np.concatenate([rare, _combined(tokens, k, need - len(rare), rule.subclasses(slot))])
        out.append(mixed(found ^ np.uint64((slot + 1) * 0x632BE59BD9B4E019 & (1 << 64) - 1)))
    return np.unique(np.concatenate(out))


def _combined(tokens: np.ndarray, k: np.ndarray, need: int, parts: int) -> np.ndarray:
    """Combinations of frequent tokens until their classes cover ``need``."""
    held: dict[tuple[int, int], list[int]] = {}
    covered = 0
    for size in range(2, int(k.max()) + 1):
        for token in tokens[k == size].tolist():
            group = held.setdefault((size, token % parts), [])
            group.append(token)
            covered += len(group) >= size
            if covered == need:
                break
        if covered == need:
            break
    found = [combo for (size, _), group in held.items() for combo in combinations(group, size)]
    out = np.zeros(len(found), np.uint64)
    with np.errstate(over="ignore"):
        for place in range(3):  # always three, so that a pair has one hash, with triples beside it or not
            part = np.array([c[place] if place < len(c) else 0 for c in found], dtype=np.uint64)
            out = mixed(out * np.uint64(0xD6E8FEB86659FD93) + part)
    return out


# --- steps -------------------------------------------------------------------------


def _sets_of(batches: Iterator[pa.RecordBatch], text: str, width: int):
    for batch in batches:
        for rows, data, offsets in pieces(batch, text):
            yield rows, token_sets(data, offsets, width)


def frequent_tokens(docs: DataFrame, text: str, rule: Rule) -> Frequent:
    """Tokens that stand at the front of many documents' sets.

    Each document gives its t + 1 lowest tokens and about as many again, since a prefix
    reaches further where it skips frequent ones; they are counted by token over all
    documents.  What is frequent only decides how a token is
    indexed, never whether a link is found.
    """

    def front(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, sets in _sets_of([batch], text, rule.width):
            yield from (s[: 2 * rule.lacking(len(s)) + 10] for s in sets if len(s))

    shared = cut_lineage(value_counts(docs.select(text), front, 2))
    bound = VERY_FREQUENT
    while shared.filter(F.col("n") > bound).count() > MOST_VERY_FREQUENT:
        bound *= 2
    table = shared.filter(F.col("n") > bound).select("value").toArrow()
    triples = np.sort(table.column("value").to_numpy().astype(np.int64).view(np.uint64))
    flags = Flags.of(shared, "value")
    release(shared)
    return Frequent(flags, triples)


def indexed(docs: DataFrame, id_column: str, text: str, frequent: Frequent, rule: Rule) -> DataFrame:
    """(id, n, node, sigs) of every row; ``node`` names the token set and is null for an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, sets in _sets_of(batches, text, rule.width):
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_digest(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([signatures(s, frequent, rule).view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                ["id", "n", "node", "sigs"],
            )

    rows = docs.select(F.col(id_column).alias("id"), F.col(text))
    shape = T.StructType(
        [
            rows.schema["id"],
            T.StructField("n", T.LongType()),
            T.StructField("node", T.LongType()),
            T.StructField("sigs", T.ArrayType(T.LongType())),
        ]
    )
    return rows.mapInArrow(run, shape)


def first_rows(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, sigs) of ``rows``, once for each of ``nodes`` (node, key, copies): that of the row ``key``.

    Signatures of nodes with one row, which are most, stay where they are.  Flags of fixed
    size let nodes of several rows, and a few others, meet their key in a join.
    """
    flags = Flags.of(nodes.filter("copies > 1"), "node")

    def held(several: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(flags.has(batch.column("node").to_numpy()) == several))

        some = rows.filter((F.size("sigs") > 0) & F.col("node").isNotNull()).select("node", "sigs", "key")
        return some.mapInArrow(run, some.schema)

    several = held(True).join(nodes.select("key"), "key", "left_semi")
    return held(False).select("node", "sigs").unionAll(several.select("node", "sigs"))


def shared_groups(index: DataFrame) -> DataFrame:
    """(node, sig) of all signatures that several rows of ``index`` (node, sigs) have; kept in the shared folder.

    Signatures are counted first; flags of fixed size then keep most single ones from
    the second shuffle, and a join drops the rest.
    """

    def flat(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield batch.column("sigs").flatten().to_numpy().view(np.uint64)

    shared = cut_lineage(value_counts(index.select("sigs"), flat, 2).select(F.col("value").alias("sig")))
    flags = Flags.of(shared, "sig")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs = batch.column("sigs")
            values = sigs.flatten().to_numpy()
            kept = flags.has(values)
            nodes = np.repeat(batch.column("node").to_numpy(), pc.list_value_length(sigs).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(nodes[kept]), pa.array(values[kept])], ["node", "sig"])

    groups = cut_lineage(index.mapInArrow(explode, "node long, sig long").join(shared, "sig", "left_semi"))
    release(shared)
    return groups


def whole_sets(docs: DataFrame, nodes: DataFrame, text: str, rule: Rule) -> DataFrame:
    """(node, tokens) of the given nodes, read from the texts again.

    Flags of fixed size keep most other documents from the shuffle.
    """
    flags = Flags.of(nodes, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets_of(batches, text, rule.width):
            names = [set_digest(s) if len(s) else None for s in sets]
            wanted = flags.has(np.array([x or 0 for x in names], np.int64))
            kept = {x: s for x, s, ok in zip(names, sets, wanted) if ok and x is not None}
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(kept), pa.int64()), pa.array([s.tobytes() for s in kept.values()], pa.binary())], ["node", "tokens"]
            )

    found = docs.select(text).mapInArrow(run, "node long, tokens binary")
    return found.dropDuplicates(["node"]).join(nodes.select("node").distinct(), "node", "left_semi")


def _shared(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def verified_pairs(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Those of the pairs (a, b) that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("ta").to_pylist(), batch.column("tb").to_pylist()
            shared = np.array([_shared(x, y) for x, y in zip(a, b)], np.int64)
            sizes = np.array([(len(x) + len(y)) // 8 for x, y in zip(a, b)], np.int64)
            kept = pa.array(rule.linked(shared, sizes))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(kept) for c in ("a", "b")], ["a", "b"])

    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def cell_links(nodes: np.ndarray, comps: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray], rule: Rule) -> list[tuple[int, int]]:
    """Links between two blocks (or inside one) that join components: a forest, not all pairs."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    two = len(np.unique(blocks)) == 2
    if n == 2:
        both = np.sort(np.concatenate(sets))
        shared = np.full((2, 2), (both[1:] == both[:-1]).sum())
    else:
        tokens, at = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(n), sizes)
        common = np.bincount(at) >= 2
        kept = common[at]
        at, owner = (np.cumsum(common) - 1)[at[kept]], owner[kept]
        shared = np.zeros((n, n), np.float32)
        wide = min(4_096, int(common.sum()))
        for low in range(0, int(common.sum()), max(1, wide)):
            some = (at >= low) & (at < low + wide)
            held = np.zeros((n, wide), np.float32)
            held[owner[some], at[some] - low] = 1
            shared += held @ held.T
    linked = rule.linked(shared.astype(np.int64), sizes[:, None] + sizes[None, :])
    linked &= comps[:, None] != comps[None, :]
    if two:
        linked &= blocks[:, None] != blocks[None, :]
    root = {int(c): int(c) for c in comps}

    def top(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    out = []
    for x, y in zip(*np.nonzero(np.triu(linked, 1))):
        a, b = top(int(comps[x])), top(int(comps[y]))
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((int(nodes[x]), int(nodes[y])))
    return out


def verified_cells(held: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """``cell_links`` of every cell: whole sets meet where the cell is, one cell after another."""
    with_sets = held.join(sets, "node").select("x", "y", "side", "node", "comp", "tokens")
    with_sets = with_sets.repartition("x", "y").sortWithinPartitions("x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(cell: pa.Table) -> list[tuple[int, int]]:
            node, comp, side = (cell.column(c).to_numpy() for c in ("node", "comp", "side"))
            return cell_links(node, comp, side, [np.frombuffer(t, np.uint64) for t in cell.column("tokens").to_pylist()], rule)

        rest: pa.Table | None = None
        for batch in and_end(batches):
            found: list[tuple[int, int]] = []
            if batch is not None:
                table = pa.Table.from_batches([batch])
                rest = table if rest is None else pa.concat_tables([rest, table])
            if rest is None or not rest.num_rows:
                continue
            x, y = rest.column("x").to_numpy(), rest.column("y").to_numpy()
            starts = np.flatnonzero(np.r_[True, (np.diff(x) != 0) | (np.diff(y) != 0)])
            ends = [*starts[1:], rest.num_rows]
            whole = len(starts) if batch is None else len(starts) - 1
            for a, z in zip(starts[:whole], ends[:whole]):
                found += links(rest.slice(a, z - a))
            rest = None if batch is None else rest.slice(starts[-1])
            if found:
                pairs = np.array(found, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return with_sets.mapInArrow(run, "a long, b long")


def _with_comp(groups: DataFrame, labels: DataFrame) -> DataFrame:
    return groups.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def _open_groups(groups: DataFrame, labels: DataFrame | None, rows: int | None) -> tuple[DataFrame, DataFrame]:
    """Members with their component, and the groups that still hold several components, with their least node."""
    members = groups.withColumn("comp", F.col("node")) if labels is None else cut_lineage(_with_comp(groups, labels), rows)
    seen = members.groupBy("sig").agg(F.min("comp").alias("low"), F.max("comp").alias("top"), F.min("node").alias("hub"))
    return members, seen.filter("low <> top")


def pivot_pairs(groups: DataFrame, labels: DataFrame | None, turn: int, rows: int | None = None) -> DataFrame:
    """Each member of an open group with one pivot of another component, kept in the shared folder; ``rows`` of ``groups``, where known."""
    members, is_open = _open_groups(groups, labels, rows)
    order = F.struct(F.xxhash64("node", F.lit(turn)).alias("order"), F.col("node").alias("pivot"), F.col("comp").alias("of"))
    pivots = members.groupBy("sig").agg(F.min(order).alias("p")).join(is_open.select("sig"), "sig", "left_semi")
    met = members.join(pivots, "sig").filter(F.col("comp") != F.col("p.of"))
    one = met.groupBy("node").agg(F.min(F.struct("p.order", "p.pivot")).alias("p"))
    pairs = cut_lineage(one.select(F.col("node").alias("a"), F.col("p.pivot").alias("b")), rows)
    if labels is not None:
        release(members)
    return pairs


def cells(groups: DataFrame, labels: DataFrame | None, block: int = BLOCK, rows: int | None = None) -> DataFrame:
    """(x, y, side, node, comp): whom to verify with whom so that no link of an open group is lost.

    Members are dealt into blocks by the least node they share a group with, which near
    copies mostly have in common, and by a hash where more than ``block`` agree in it.  A
    cell holds those members of blocks x and y that share a group across them (or inside
    one block), unless they all lie in one component.  ``rows`` of ``groups`` are written
    in few files, where their number is known.
    """
    every, is_open = _open_groups(groups, labels, rows)
    members = cut_lineage(every.join(is_open, "sig").select("sig", "node", "comp", "hub"), rows)
    if labels is not None:
        release(every)
    family = members.groupBy("node").agg(F.min("hub").alias("family"))
    counts = family.groupBy("family").agg(F.ceil(F.count("*") / block).alias("parts"))
    part = F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts"))
    dealt = family.join(counts, "family").select("node", F.xxhash64("family", part).alias("block"))
    placed = cut_lineage(members.drop("hub").join(dealt, "node"), rows)
    release(members)
    others = placed.select("sig", F.col("block").alias("other")).distinct()
    held = placed.join(others, "sig").select(
        F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), F.col("block").alias("side"), "node", "comp"
    )
    held = cut_lineage(held.distinct())
    release(placed)
    several = held.groupBy("x", "y").agg(F.min("comp").alias("low"), F.max("comp").alias("top")).filter("low <> top")
    kept = cut_lineage(held.join(several.select("x", "y"), ["x", "y"], "left_semi"), held.count())
    release(held)
    return kept


#: Rows that travel to Python carry whole sets here, so they go in small batches.  Shuffle files of a step go
#: with its end: its result is in the shared folder by then, and the driver may collect its garbage much later.
_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


@contextmanager
def small_steps(spark: SparkSession) -> Iterator[None]:
    """The settings hold for the steps that run inside; afterwards they are as before."""
    before = {k: spark.conf.get(k, None) for k in _SETTINGS}
    for k, v in _SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _linked(
    docs: DataFrame, rule: Rule, id_column: str, text: str, pivot_turns: int, block: int, pivot_least: int
) -> tuple[DataFrame, DataFrame]:
    """All rows (id, n, node), and the component of each node; both are kept in the shared folder, what they rest on is not."""
    source = docs.select(F.col(id_column), F.col(text))
    frequent = frequent_tokens(source, text, rule)
    index = cut_lineage(indexed(source, id_column, text, frequent, rule).withColumn("key", F.monotonically_increasing_id()))
    rows = cut_lineage(index.select("id", "n", "node"))
    named = index.filter("node is not null").groupBy("node")
    nodes = cut_lineage(named.agg(F.min("id").alias("low"), F.min("key").alias("key"), F.count("*").alias("copies")))
    groups = shared_groups(first_rows(index, nodes))
    release(index)
    rows_grouped = groups.count()
    edges, labels = None, None
    big = groups.groupBy("sig").agg(F.count("*").alias("size")).filter(F.col("size") >= pivot_least).select("sig")
    big_groups = cut_lineage(groups.join(big, "sig", "left_semi"), rows_grouped)
    if not big_groups.isEmpty():
        sets = cut_lineage(whole_sets(source, big_groups.select("node").distinct(), text, rule))
        for turn in range(pivot_turns):
            pairs = pivot_pairs(big_groups, labels, turn, rows_grouped)
            if pairs.isEmpty():
                release(pairs)
                break
            found = verified_pairs(pairs, sets, rule)
            before, edges = edges, cut_lineage(found if edges is None else edges.union(found))
            release(pairs, *([] if before is None else [before]))
            labels = components(edges, (turn + 1) * rows_grouped)
        release(sets)
    release(big_groups)
    held = cells(groups, labels, block, rows_grouped)
    release(groups)
    rows_held = held.count()
    if rows_held:
        found = verified_cells(held, whole_sets(source, held.select("node").distinct(), text, rule), rule)
        # A cell gives fewer links than it has members.
        labels = components(found if edges is None else edges.union(found), rows_held + pivot_turns * rows_grouped)
    release(held, *([] if edges is None else [edges]))
    known = nodes.select("node", "low")
    if labels is not None:
        joined = known.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        least = joined.groupBy("comp").agg(F.min("low").alias("component"))
        known = joined.join(least, "comp").select("node", "component")
    else:
        known = known.select("node", F.col("low").alias("component"))
    known = cut_lineage(known, nodes.count())
    release(nodes)
    return rows, known


def linked_documents(
    docs: DataFrame,
    rule: Rule = Rule(),
    id_column: str = "doc_id",
    text: str = "text",
    pivot_turns: int = 2,
    block: int = BLOCK,
    pivot_least: int = PIVOT_LEAST,
) -> DataFrame:
    """(id, ``n_shingles``, ``component_id``) for every row of ``docs``.

    A document's set holds its distinct runs of ``rule.width`` words (A-Z lower-cased,
    words between white space); with fewer words the whole sequence is the one token.
    ``component_id`` is the least id that links reach, itself included.  A null text or
    one without words has an empty set and is linked with nothing, not even its like.
    Equal rows, and rows with equal sets, share a component.  A null id takes part in
    links, and gets the least id of its component, or null if it stands alone.  An empty
    table gives an empty result.  Other columns are not read.

    Work: texts are read three times (front tokens, index, sets of candidates); what is
    shuffled are 64-bit tokens of prefixes, and the sets of candidates (twice).  Equal sets
    are indexed once.  Each step's shuffle files go with its end, and its table with the last step that reads it.  No group meets in one task: groups are combined by aggregates,
    big ones (``pivot_least`` members or more) meet a pivot in each of ``pivot_turns`` turns, and what is left is verified
    in cells of about ``2 * block`` sets at most.
    """
    with small_steps(docs.sparkSession):
        rows, known = _linked(docs, rule, id_column, text, pivot_turns, block, pivot_least)
    return rows.join(known, "node", "left").select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )
