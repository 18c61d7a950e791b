"""Documents linked by the Hamming distance of their SimHashes, by a Gray-order hierarchical index.

The index has two storeys.

* The upper one is a table.  The 64 bits are cut into parts; two fingerprints that differ in at
  most ``distance`` bits agree in all but ``distance`` of them.  For each choice of
  ``parts - distance`` parts the fingerprints are put in order of their Gray rank with those
  parts in front, so that all that agree there lie together: a group has a masked bit pattern in
  common, in which a linked pair has no difference.  Range partitions hold consecutive ranks.
* The lower one is a tree over each block of consecutive fingerprints of a group.  A node keeps
  the bits that all fingerprints below it share as (mask, bits); a child keeps what it shares
  beyond that.  Pairs of nodes go down together and add up the differences of what both sides
  have fixed so far; a pair of whole groups is dropped once these are over ``distance``, or when
  both sides already lie in one component.  At the leaves the sum is the distance itself.

Blocks of one group that fall into several partitions or are cut for their size meet afterwards:
their masked patterns and components decide which pairs of blocks have to.  A block has a bounded
size, and each gives the edges of a forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.components import components
from pageloom.llm.counting import and_end
from pageloom.llm.text import FOLD_BYTES, blank_bytes, pieces, words
from pageloom.session import cut_lineage

WIDTH = 4
SEED = 42
DISTANCE = 4
#: Fingerprints of a block, the most that a tree is built over.
BLOCK = 2_048
#: Fingerprints that a group is to hold on average at most; more of them take more tables.
GROUP = 256
#: Children of a node.
FAN = 8
#: Blocks that a task works on at once.
_BLOCKS_AT_ONCE = 16
#: Pairs of nodes that go down at once.
_AT_ONCE = 1 << 14
_HASHES_AT_ONCE = 1 << 16


# --- fingerprints --------------------------------------------------------------------------


def codes_of(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The SimHash of each text of a piece.

    Hashed is each run of ``width`` words (A-Z lower-cased, joined by one space), or the whole
    sequence if it is shorter.
    """
    found = words(data, offsets)
    # The words with one space behind each.
    kept = np.zeros(len(data) + 1, dtype=bool)
    kept[:-1] = ~blank_bytes(data)
    place = np.cumsum(kept)
    length = found.end - found.start
    begin = (place[found.start] - 1 if len(length) else length) + np.arange(len(length))
    flat = np.full(int(length.sum()) + len(length), 32, np.uint8)
    flat[np.arange(int(length.sum())) + np.repeat(np.arange(len(length)), length)] = np.frombuffer(FOLD_BYTES, np.uint8)[data[kept[:-1]]]
    raw, end = flat.tobytes(), begin + length
    runs = np.where(found.counts >= width, found.counts - width + 1, np.minimum(found.counts, 1))
    owner = np.repeat(np.arange(len(runs)), runs)
    first = found.first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    last = np.minimum(first + width, found.first[owner + 1]) - 1
    sums, digest = np.zeros((len(runs), 64), np.int64), xxhash.xxh64_intdigest
    for low in range(0, len(owner), _HASHES_AT_ONCE):
        some = slice(low, low + _HASHES_AT_ONCE)
        spans = zip(begin[first[some]].tolist(), end[last[some]].tolist())
        hashes = np.array([digest(raw[a:z], SEED) for a, z in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        edges = np.flatnonzero(np.diff(owner[some], prepend=-1))
        sums[owner[some][edges]] += np.add.reduceat(bits, edges, axis=0, dtype=np.int32)
    return np.packbits(2 * sums > runs[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(id, code) of every row: the SimHash of the whole text as a signed long, zero without words."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, data, offsets in pieces(batch, text):
                codes = codes_of(data, offsets, width).view(np.int64)
                yield pa.RecordBatch.from_arrays([some.column("id"), pa.array(codes)], ["id", "code"])

    return rows.mapInArrow(run, T.StructType([rows.schema["id"], T.StructField("code", T.LongType())]))


# --- Gray order ------------------------------------------------------------------------------


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the Gray sequence, in which neighbours differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def part_count(n: int, distance: int, group: int = GROUP) -> int:
    """Parts of the 64 bits, so that n even fingerprints have groups of ``group`` at most."""
    parts = distance + 1
    while n >> min(key_bits(parts, table, distance) for table in tables(parts, distance)) > group and parts < 2 * distance:
        parts += 1
    return parts


def tables(parts: int, distance: int) -> list[tuple[int, ...]]:
    """The choices of parts that stand in front."""
    return list(combinations(range(parts), parts - distance))


def _cuts(parts: int) -> list[int]:
    return [64 * k // parts for k in range(parts + 1)]


def key_bits(parts: int, table: tuple[int, ...], distance: int) -> int:
    cuts = _cuts(parts)
    return sum(cuts[k + 1] - cuts[k] for k in table)


def arranged(codes: np.ndarray, parts: int, table: tuple[int, ...]) -> np.ndarray:
    """The codes with the bits of the parts in ``table`` in front."""
    cuts, out = _cuts(parts), np.zeros_like(codes)
    for k in [*table, *(k for k in range(parts) if k not in table)]:
        size = cuts[k + 1] - cuts[k]
        out = out << np.uint64(size) | codes >> np.uint64(cuts[k]) & np.uint64((1 << size) - 1)
    return out


# --- the tree ----------------------------------------------------------------------------------


class Tree:
    """Trees over blocks of consecutive codes, all of them in the same arrays.

    ``levels[0]`` are the codes, each further level has one node for up to ``FAN`` of the one
    below; the last one has one node for each block.  ``label`` names the component of a code
    by one of its places.
    """

    def __init__(self, codes: np.ndarray, starts: np.ndarray, label: np.ndarray | None = None) -> None:
        self.codes = codes
        self.label = np.arange(len(codes)) if label is None else label
        sizes = np.diff(np.append(starts, len(codes)))
        place = np.arange(len(codes)) - np.repeat(starts, sizes)
        self.first = [np.arange(len(codes) + 1)]  # of each node: its first child
        self.leaf = [np.arange(len(codes))]  # of each node: its first code
        self.mask, self.bits = [np.full(len(codes), ~np.uint64(0))], [codes]
        span = 1
        while len(self.leaf[-1]) > len(starts):
            span *= FAN
            heads = np.flatnonzero(place % span == 0)
            self.first.append(np.append(np.searchsorted(self.leaf[-1], heads), len(self.leaf[-1])))
            self.leaf.append(heads)
            both, any_ = np.bitwise_and.reduceat(codes, heads), np.bitwise_or.reduceat(codes, heads)
            self.mask.append(~(both ^ any_))
            self.bits.append(both)

    @property
    def top(self) -> int:
        return len(self.leaf) - 1

    def _bounds(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Least and greatest label below each node."""
        return [np.minimum.reduceat(self.label, x) for x in self.leaf], [np.maximum.reduceat(self.label, x) for x in self.leaf]

    def merge(self, u: np.ndarray, v: np.ndarray) -> bool:
        """Joins the components of the given places; whether anything changed."""
        label, changed = self.label, False
        while True:
            a, b = label[u], label[v]
            apart = a != b
            if not apart.any():
                return changed
            changed, u, v = True, u[apart], v[apart]
            np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
            while True:
                above = label[label]
                if (above == label).all():
                    break
                label[:] = above

    def join(self, a: np.ndarray, b: np.ndarray, distance: int) -> None:
        """Merges all codes below the top nodes a and b (a pair each) that differ in at most ``distance`` bits."""
        low, high = self._bounds()
        known = (self.mask[-1][a] & self.mask[-1][b]) if len(a) else np.zeros(0, np.uint64)
        apart = np.bitwise_count((self.bits[-1][a] ^ self.bits[-1][b]) & known).astype(np.int16)
        stack = [(self.top, a[apart <= distance], b[apart <= distance], apart[apart <= distance])]
        while stack:
            level, a, b, apart = stack.pop()
            if len(a) > _AT_ONCE:
                stack.append((level, a[_AT_ONCE:], b[_AT_ONCE:], apart[_AT_ONCE:]))
                a, b, apart = a[:_AT_ONCE], b[:_AT_ONCE], apart[:_AT_ONCE]
            one = (low[level][a] == high[level][a]) & (low[level][b] == high[level][b]) & (low[level][a] == low[level][b])
            a, b, apart = a[~one], b[~one], apart[~one]
            if not len(a):
                continue
            if level == 0:
                if self.merge(a, b):
                    low, high = self._bounds()
                continue
            known = self.mask[level][a] & self.mask[level][b]
            x, y, parent = self._children(level, a, b)
            # What is fixed on both sides here and was not above.
            fixed = self.mask[level - 1][x] & self.mask[level - 1][y] & ~known[parent]
            apart = apart[parent] + np.bitwise_count((self.bits[level - 1][x] ^ self.bits[level - 1][y]) & fixed).astype(np.int16)
            near = apart <= distance
            if level == 1:
                near &= x != y
            stack.append((level - 1, x[near], y[near], apart[near]))

    def _children(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first = self.first[level]
        wide, high = first[a + 1] - first[a], first[b + 1] - first[b]
        size = wide * high
        parent = np.repeat(np.arange(len(a)), size)
        k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        x, y = first[a][parent] + k // high[parent], first[b][parent] + k % high[parent]
        once = (a[parent] != b[parent]) | (x <= y)
        return x[once], y[once], parent[once]


def block_forest(codes: np.ndarray, starts: np.ndarray, distance: int) -> np.ndarray:
    """For each code of the blocks one code of its component inside the block."""
    tree = Tree(codes, starts)
    inside = np.ones(len(codes), dtype=bool)
    inside[starts] = False
    at = np.flatnonzero(inside)
    near = at[np.bitwise_count(codes[at] ^ codes[at - 1]) <= distance]
    tree.merge(near - 1, near)
    tops = np.arange(len(starts))
    tree.join(tops, tops, distance)
    return codes[tree.label]


# --- Spark steps ---------------------------------------------------------------------------------


def index_entries(codes: DataFrame, parts: int, distance: int) -> DataFrame:
    """(t, rank, code): every code in every table; ``rank`` is the Gray rank, moved into the signed range."""
    fronts = tables(parts, distance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("code").to_numpy().view(np.uint64)
            for t, front in enumerate(fronts):
                rank = (gray_rank(arranged(own, parts, front)) ^ np.uint64(1 << 63)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), t), pa.int32()), pa.array(rank), batch.column("code")], ["t", "rank", "code"])

    return codes.select("code").mapInArrow(run, "t int, rank long, code long")


def block_links(entries: DataFrame, parts: int, distance: int, block: int) -> DataFrame:
    """(t, key, block, code, root): ``root`` is linked with ``code`` inside its block.

    Rows of groups that may go on in another block carry the number of the block (the rank it
    begins with) and the ``key`` of the group; of other groups only codes that are not their
    own root are listed.
    """
    bits = np.array([key_bits(parts, front, distance) for front in tables(parts, distance)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] = [np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        waiting, held, last = [], 0, None
        for batch in and_end(batches):
            if batch is not None:
                waiting.append([batch.column(c).to_numpy() for c in ("t", "rank", "code")])
                held += batch.num_rows
                if held < _BLOCKS_AT_ONCE * block:
                    continue
            t, rank, code = (np.concatenate(x) for x in zip(rest, *waiting))
            waiting, held = [], 0
            key = ((rank.view(np.uint64) ^ np.uint64(1 << 63)) >> (np.uint64(64) - bits[t])).astype(np.int64)
            heads = np.flatnonzero(np.r_[len(t) > 0, (np.diff(t) != 0) | (np.diff(key) != 0)])
            size = len(t)
            if batch is not None:  # the last group may go on; only whole blocks of it are ready
                size = heads[-1] + (size - heads[-1]) // block * block
            rest = [t[size:], rank[size:], code[size:]]
            if not size:
                continue
            heads = heads[heads < size]
            length = np.diff(np.append(heads, size))
            name = lambda at: (int(t[at]), int(key[at]))
            is_open = length > block
            is_open[0] |= last in (None, name(0))
            is_open[-1] |= size == len(t) or name(size) == name(size - 1)
            last = name(size - 1)
            is_open = np.repeat(is_open, length)
            starts = np.flatnonzero((np.arange(size) - np.repeat(heads, length)) % block == 0)
            own = code[:size].view(np.uint64)
            root = block_forest(own, starts, distance)
            number = np.repeat(rank[starts], np.diff(np.append(starts, size)))
            kept = is_open | (root != own)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(t[:size][kept]),
                    pa.array(key[:size][kept]),
                    pa.array(number[kept], mask=~is_open[kept]),
                    pa.array(code[:size][kept]),
                    pa.array(root.view(np.int64)[kept]),
                ],
                ["t", "key", "block", "code", "root"],
            )

    dealt = entries.repartitionByRange("t", "rank").sortWithinPartitions("t", "rank")
    return dealt.mapInArrow(run, "t int, key long, block long, code long, root long")


def _definite(a: str, b: str) -> str:
    """Differences of two blocks in the bits that each of them has fixed."""
    return f"bit_count(({a}.both ^ {b}.both) & ~({a}.both ^ {a}.any) & ~({b}.both ^ {b}.any))"


def block_cells(found: DataFrame, labels: DataFrame, distance: int) -> DataFrame:
    """(t, key, x, y, side, code, comp): the blocks x and y of a group that have to meet, with their codes."""
    members = found.filter("block is not null").select("t", "key", "block", "code")
    several = members.groupBy("t", "key").agg(F.min("block").alias("low"), F.max("block").alias("high")).filter("low < high")
    held = members.join(several.select("t", "key"), ["t", "key"], "left_semi")
    held = held.join(labels.withColumnRenamed("node", "code"), "code", "left").withColumn("comp", F.coalesce("comp", "code"))
    held = cut_lineage(held)
    nodes = held.groupBy("t", "key", "block").agg(
        F.bit_and("code").alias("both"), F.bit_or("code").alias("any"), F.min("comp").alias("low"), F.max("comp").alias("high")
    )
    nodes = cut_lineage(nodes)
    one = "a.low = a.high and b.low = b.high and a.low = b.low"
    pairs = nodes.alias("a").join(nodes.alias("b"), F.expr("a.t = b.t and a.key = b.key and a.block < b.block"))
    pairs = pairs.filter(f"not ({one}) and {_definite('a', 'b')} <= {distance}")
    pairs = pairs.select("a.t", "a.key", F.col("a.block").alias("x"), F.col("b.block").alias("y"))
    sides = pairs.withColumn("block", F.explode(F.array("x", "y")))
    return sides.join(held, ["t", "key", "block"]).select("t", "key", "x", "y", F.col("block").alias("side"), "code", "comp")


def cell_links(cells: DataFrame, distance: int) -> DataFrame:
    """(code, root): what is linked across the two blocks of a cell beyond the components known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in and_end(batches):
            if batch is not None:
                some = pa.Table.from_batches([batch])
                rest = some if rest is None else pa.concat_tables([rest, some])
            if rest is None or not rest.num_rows:
                continue
            names = np.stack([rest.column(c).to_numpy() for c in ("t", "key", "x", "y")])
            heads = np.flatnonzero(np.r_[True, (np.diff(names, axis=1) != 0).any(axis=0)])
            ends = np.append(heads[1:], rest.num_rows)
            whole = len(heads) if batch is None else len(heads) - 1
            for a, z in zip(heads[:whole], ends[:whole]):
                cell = rest.slice(a, z - a)
                codes = cell.column("code").to_numpy().view(np.uint64)
                side = cell.column("side").to_numpy()
                starts = np.flatnonzero(np.r_[True, side[1:] != side[:-1]])
                _, at, known = np.unique(cell.column("comp").to_numpy(), return_index=True, return_inverse=True)
                tree = Tree(codes, starts, at[known])
                before = tree.label.copy()
                tree.join(np.array([0]), np.array([1]), distance)
                new = np.flatnonzero(before != tree.label)
                if len(new):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(codes[new].view(np.int64)), pa.array(codes[tree.label[new]].view(np.int64))], ["code", "root"]
                    )
            rest = None if batch is None else rest.slice(heads[-1])

    dealt = cells.repartition("t", "key", "x", "y").sortWithinPartitions("t", "key", "x", "y", "side")
    return dealt.mapInArrow(run, "code long, root long")


def linked_codes(codes: DataFrame, distance: int = DISTANCE, block: int = BLOCK, group: int = GROUP) -> DataFrame | None:
    """(node, comp) of the distinct ``code`` values that are linked with another one; None if there are none."""
    parts = part_count(codes.count(), distance, group)
    found = cut_lineage(block_links(index_entries(codes, parts, distance), parts, distance, block))
    edges = found.filter("code <> root").select(F.col("code").alias("a"), F.col("root").alias("b"))
    labels = components(edges)
    more = cut_lineage(cell_links(block_cells(found, labels, distance), distance))
    if more.isEmpty():
        return labels
    return components(edges.union(more.select(F.col("code").alias("a"), F.col("root").alias("b"))))


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    distance: int = DISTANCE,
    block: int = BLOCK,
    group: int = GROUP,
) -> DataFrame:
    """(id, ``fingerprint``, ``component_id``) for every row of ``docs``.

    A fingerprint (16 lower-case hex digits) has the bits that are set in over half of the
    XXH64 values of the text's runs of ``width`` words, repeats included.  A null text and one
    without words have fingerprint zero and are linked like any other.  ``component_id`` is the
    least id that links reach, itself included; a null id takes part in links and gets the
    least id of its component, or null if that has none.  Equal rows are rows of their own.
    An empty table gives an empty result; other columns are not read.

    Work: texts are read once.  Distinct fingerprints travel once for each table (5 up to some
    two million of them, 15, 35 or 70 beyond), and once more for each block that a block of
    theirs has to meet.  Nothing but counts reaches the driver.
    """
    rows = cut_lineage(fingerprints(docs, id_column, text, width))
    codes = cut_lineage(rows.groupBy("code").agg(F.min("id").alias("low")))
    labels = linked_codes(codes, distance, block, group).withColumnRenamed("node", "code")
    named = codes.join(labels, "code", "left").withColumn("comp", F.coalesce("comp", "code"))
    least = named.groupBy("comp").agg(F.min("low").alias("component_id"))
    known = named.join(least, "comp").select("code", "component_id")
    return rows.join(known, "code").select(
        F.col("id").alias(id_column), F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id"
    )
