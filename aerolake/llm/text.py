"""Vectorised word splitting and hashing over the UTF-8 buffers of an Arrow batch.

Used inside tasks only: Spark splits the table, each task walks its rows in chunks of bounded size.
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20
BLANKS = b" \t\n\x0b\x0c\r"
_GOLD = 0x9E3779B97F4A7C15


#: Rows and bytes of whole texts that travel to a Python worker at once; several workers share an executor.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "16777216"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder; the session is told to send texts to Python in small batches."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, named by spark.checkpoint.dir; a local one only where that is unset and Spark is local."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path is None:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="aerolake-checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise in the shared folder: cuts the lineage and survives a lost executor.

    Spark removes shuffle files and older checkpoints once the driver has collected the objects that stand for them; a loop of
    checkpoints makes too little garbage for that to happen by itself, so it is asked for here.
    """
    spark = df.sparkSession
    shared_folder(spark)
    out = df.checkpoint(eager=True)
    del df
    spare_driver(spark)
    return out


def spare_driver(spark: SparkSession) -> None:
    """Hand back what this process and the driver's JVM hold no longer: plans, collected rows, closures of finished jobs."""
    release()
    spark.sparkContext._jvm.System.gc()  # a full collection gives heap back


def written(df: DataFrame) -> DataFrame:
    """Write a table of its own in the shared folder and read it back: like ``checkpointed``, but compressed, and read by columns."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4()}"
    df.write.option("compression", "zstd").parquet(path)
    spare_driver(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release() -> None:
    """Hand memory that this process has free back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for mapInArrow, after which the worker hands free memory back: workers are kept for later tasks, and several share an executor."""

    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def held_out(doc_id: Column, remainder: int = 0) -> Column:
    """True for the fold from which nothing is learnt: crc32 of the id's text modulo 5; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == remainder, F.lit(False))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: One random-looking 64-bit number per byte value.
BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_GOLD))


def byte_set(members: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(members)] = True
    return out


@dataclass
class Chunk:
    """Some consecutive rows of a batch: their bytes, and row i is data[offsets[i]:offsets[i + 1]]."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def row_sums(self, per_byte: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(per_byte, dtype=np.int64)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a string column into chunks of about ``limit`` bytes, whole rows each; null counts as empty."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    column = column.fill_null("")
    _, where, raw = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield Chunk(i, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        i = j


@dataclass
class Words:
    """Words of a chunk: word w is data[start[w]:end[w]] and belongs to row[w]; row i has first[i]:first[i + 1]."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def split_words(chunk: Chunk, breaks: np.ndarray | None = None) -> Words:
    """Maximal runs of bytes that aren't breaks (blank bytes 0x20, 0x09-0x0D by default); never across rows."""
    inside = ~(byte_set(BLANKS) if breaks is None else breaks)[chunk.data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    borders = chunk.offsets[:-1][chunk.offsets[:-1] < len(inside)]
    begins[borders] = inside[borders]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    lasts = chunk.offsets[1:][chunk.offsets[1:] > 0] - 1
    stops[lasts] = inside[lasts]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    first = np.searchsorted(start, chunk.offsets)
    return Words(start, end, np.repeat(np.arange(chunk.rows), np.diff(first)), first)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, block: int = 1 << 15) -> np.ndarray:
    """64-bit polynomial hash of each data[start:end], words in order and apart, in blocks of words so that memory stays bounded.

    A word's polynomial is the difference of two running sums over its block, divided by the power at its begin (odd, so it has an inverse modulo 2**64)."""
    out = np.empty(len(start), dtype=np.uint64)
    powers = inverses = np.ones(1, dtype=np.uint64)
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + block, side="right")))
        first, size = start[lo], int(end[hi - 1] - start[lo])
        if size >= len(powers):
            powers, inverses = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(size, block), x, dtype=np.uint64)])) for x in (_GOLD | 1, pow(_GOLD | 1, -1, 1 << 64)))
        total = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(BYTE_CODES[data[first:first + size]] * powers[1:size + 1], out=total[1:])
        at = start[lo:hi] - first
        out[lo:hi] = mix((total[end[lo:hi] - first] - total[at]) * inverses[at] + (end[lo:hi] - start[lo:hi]).astype(np.uint64))
        lo = hi
    return out


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp value (modulo 2**64) of each ``width`` consecutive hashes, built by doubling.

    Sequences are told apart by 64 bits; whoever needs windows inside one row masks the others.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    base, done, out = _GOLD | 1, 0, np.zeros(n, dtype=np.uint64)
    span, level = 1, hashes
    while True:
        if width & span:
            out = out * np.uint64(pow(base, span, 1 << 64)) + level[done:done + n]
            done += span
        if span * 2 > width:
            return mix(out)
        level = level[:len(level) - span] * np.uint64(pow(base, span, 1 << 64)) + level[span:]
        span *= 2


def inside_row(words: Words, width: int) -> np.ndarray:
    """Mask of the windows of ``width`` words that lie in one row."""
    n = len(words.row) - width + 1
    return words.row[:n] == words.row[width - 1:] if n > 0 else np.zeros(0, dtype=bool)


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask of the n words that lie in a window beginning at one of ``starts``."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + width, n), -1)
    return np.cumsum(edge[:n]) > 0


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def slices(data: np.ndarray, start: np.ndarray, end: np.ndarray, kind: pa.DataType) -> pa.Array:
    """data[start[w]:end[w]] of every w as an Arrow array of strings or binaries."""
    length = end - start
    offsets = np.concatenate([[0], np.cumsum(length)])
    inner = np.arange(offsets[-1]) - np.repeat(offsets[:-1], length)
    return pa.Array.from_buffers(kind, len(start), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[np.repeat(start, length) + inner].tobytes())])
