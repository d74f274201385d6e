"""Count sketches of fixed size: they order hashed things by rarity, or tell what surely isn't there.

What is built on them stays exact whatever they hold; beyond a few million things they only save less.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import tidy

#: Counters of a sketch and rows in which they travel; the size doesn't depend on the data.
COUNTERS, PARTS = 1 << 22, 64


def sketch(frame: DataFrame, values) -> np.ndarray:
    """How often the numbers that ``values(batch)`` yields occur, modulo COUNTERS, as 16-bit ``heights``; summed up by streams of partial sketches.

    A task's partial count stops at 255: counts only order shingles.
    """

    def count(batches):
        total, held, size = np.zeros(COUNTERS, dtype=np.int64), [], 0

        def settle():
            total[:] += np.bincount(np.concatenate(held), minlength=COUNTERS)
            held.clear()

        for batch in batches:
            for some in values(batch):
                held.append((some.view(np.uint64) % np.uint64(COUNTERS)).astype(np.int64))
                size += len(some)
                if size > COUNTERS // 2:
                    settle()
                    size = 0
        if held:
            settle()
        if total.any():
            parts = np.minimum(total, 255).astype(np.uint8).reshape(PARTS, -1)
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["part", "counts"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                total[part] = total.get(part, 0) + np.frombuffer(counts.as_py(), dtype=np.uint8).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([heights(p).tobytes() for p in total.values()], pa.binary())], ["part", "counts"])

    shape = "part int, counts binary"
    out = np.zeros((PARTS, COUNTERS // PARTS), dtype=np.uint16)
    for part, counts in frame.mapInArrow(tidy(count), shape).repartition("part").mapInArrow(tidy(add), shape).collect():  # COUNTERS numbers in all
        out[part] = np.frombuffer(counts, dtype=np.uint16)
    return out.ravel()


def heights(counts: np.ndarray) -> np.ndarray:
    """Counts in 16 bits, in the same order: as they are below 32,768, above that 1,024 steps for each doubling."""
    return np.where(counts < 1 << 15, counts, (1 << 15) + 1024 * (np.log2(np.maximum(counts, 1 << 15)) - 15)).astype(np.uint16)


def present(keys: DataFrame) -> np.ndarray:
    """A bit for each of COUNTERS slots: may one of ``keys`` (one column of longs, no nulls) be there?  ``among`` asks for slots."""

    def mark(batches):
        seen = np.zeros(COUNTERS, dtype=bool)
        for batch in batches:
            seen[slots(batch.column(0))] = True
        if seen.any():
            parts = np.packbits(seen, bitorder="little").reshape(PARTS, -1)
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["part", "bits"])

    def join(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, bits in zip(batch.column(0).to_pylist(), batch.column(1)):
                total[part] = total.get(part, 0) | np.frombuffer(bits.as_py(), dtype=np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([p.tobytes() for p in total.values()], pa.binary())], ["part", "bits"])

    shape = "part int, bits binary"
    out = np.zeros((PARTS, COUNTERS // 8 // PARTS), dtype=np.uint8)
    for part, bits in keys.mapInArrow(tidy(mark), shape).repartition("part").mapInArrow(tidy(join), shape).collect():  # COUNTERS bits in all
        out[part] = np.frombuffer(bits, dtype=np.uint8)
    return out.ravel()


def among(wanted: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """Which slots have their bit in ``wanted``."""
    return wanted[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 > 0


def slots(keys: pa.Array) -> np.ndarray:
    return (keys.to_numpy(zero_copy_only=False).view(np.uint64) % np.uint64(COUNTERS)).astype(np.int64)


def part(frame: DataFrame, column: str, wanted: np.ndarray, inside: bool) -> DataFrame:
    """The rows whose ``column`` may be among the wanted keys, or the others (which surely aren't)."""
    place = frame.columns.index(column)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(among(wanted, slots(batch.column(place))) == inside))

    return frame.mapInArrow(tidy(run), frame.schema)
