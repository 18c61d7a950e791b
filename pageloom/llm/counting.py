"""Counts of 64-bit values over all rows, and sets of them as flags of fixed size."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.text import give_back

def and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    """The batches, and None once they are over."""
    yield from batches
    yield None


#: Flags of a ``Flags`` set: 8 MB, whatever is put in.
FLAG_BITS = 26


def _distinct(values: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and how many times each occurs."""
    if times is None:
        values = np.sort(values)
    else:
        order = np.argsort(values)
        values, times = values[order], times[order]
    edges = np.flatnonzero(np.diff(values, prepend=~values[:1]))
    if times is None:
        return values[edges], np.diff(np.append(edges, len(values)))
    return values[edges], np.add.reduceat(times, edges) if len(edges) else times


def value_counts(rows: DataFrame, values: Callable[[pa.RecordBatch], Iterator[np.ndarray]], least: int) -> DataFrame:
    """(value, n) of the 64-bit values that ``values`` gives for all batches, those with n >= ``least``.

    A batch sends each of its values once, and the number of those that it has several times.
    Values travel as byte strings, one for each range of values and batch, and
    each range is counted by one task; a range is a part of the hashes and so of even size,
    and a value of many rows comes once a batch.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(1, (2 * parts - 1).bit_length())

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(values(batch))
            if not found:
                continue
            every, n = _distinct(np.concatenate(found))
            part = (every >> np.uint64(64 - bits)).astype(np.int64)
            edges = np.flatnonzero(np.diff(part, prepend=-1))
            ends = np.append(edges[1:], len(part))[: len(edges)]
            several = np.flatnonzero(n > 1)
            # Place inside the range and number, in one value.
            noted = several - edges[np.searchsorted(edges, several, side="right") - 1] << 32 | n[several]
            cuts = np.searchsorted(several, np.append(edges, len(every)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[edges], pa.int64()),
                    pa.array([every[a:z].tobytes() for a, z in zip(edges, ends)], pa.binary()),
                    pa.array([noted[a:z].tobytes() for a, z in zip(cuts[:-1], cuts[1:])], pa.binary()),
                ],
                ["part", "held", "times"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Counts so far and what came since, which is counted once it has grown as large.
        every, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        waiting: list[np.ndarray] = []
        many: list[np.ndarray] = []
        size = 0
        for batch in and_end(batches):
            if batch is not None:
                for held, times in zip(batch.column("held"), batch.column("times")):
                    waiting.append(np.frombuffer(held.as_buffer(), np.uint64).copy())
                    noted = np.frombuffer(times.as_buffer(), np.int64)
                    many.append(np.ones(len(waiting[-1]), np.uint32))
                    many[-1][noted >> 32] = noted & 0xFFFFFFFF
                    size += len(waiting[-1])
            if waiting and (batch is None or size > max(len(every), 1 << 20)):
                new, times = _distinct(np.concatenate(waiting), np.concatenate(many).astype(np.int64))
                waiting, many, size = [], [], 0
                every, n = _distinct(np.concatenate([every, new]), np.concatenate([n, times]))
        kept = n >= least
        found, n = every[kept].view(np.int64), n[kept]
        del every, kept
        for low in range(0, len(n), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(found[low : low + (1 << 16)]), pa.array(n[low : low + (1 << 16)])], ["value", "n"])
        give_back()

    dealt = rows.mapInArrow(deal, "part long, held binary, times binary").repartition(parts, "part")
    return dealt.mapInArrow(count, "value long, n long")


class Flags:
    """A set of 64-bit values by their leading bits: never misses one, may let others pass."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    def __getstate__(self) -> bytes:
        # Tasks get the flags with their code; few flags take little room.
        return zlib.compress(self.bits.tobytes(), 1)

    def __setstate__(self, packed: bytes) -> None:
        self.bits = np.frombuffer(zlib.decompress(packed), np.uint64)

    @classmethod
    def of(cls, rows: DataFrame, column: str) -> Flags:
        """Combined by the executors; the driver gets at most 2^20 words."""
        slot = F.shiftrightunsigned(column, 64 - FLAG_BITS)
        packed = rows.select(slot.alias("slot")).select(
            F.shiftright("slot", 6).alias("word"), F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("bit")
        )
        table = packed.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
        bits = np.zeros(1 << FLAG_BITS - 6, np.uint64)
        bits[table.column("word").to_numpy().astype(np.int64)] = table.column("bits").to_numpy().astype(np.int64).view(np.uint64)
        return cls(bits)

    def has(self, values: np.ndarray) -> np.ndarray:
        slot = values.view(np.uint64) >> np.uint64(64 - FLAG_BITS)
        return (self.bits[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)
