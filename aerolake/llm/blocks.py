"""Blocks of documents with a dictionary of keys each, and the join that looks their keys up.

A block is one row: the key columns of its documents, their contents as positions in the block's dictionary, and the
dictionary itself (column ``keys``).  What is known of a key over the whole corpus comes back to the block through two shuffles of
dictionary rows, whose number is bounded by blocks times distinct keys of a block and is far below the number of occurrences.
A key that is in every block is one row a block; the join splits such keys.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import shared_folder

#: Bytes of text from which a block is closed.
BLOCK_BYTES = 8 << 20


class Numbers:
    """Names of the blocks of one task: its partition and a running number."""

    def __init__(self) -> None:
        context = TaskContext.get()
        self.next = (context.partitionId() if context else 0) << 32

    def take(self) -> int:
        self.next += 1
        return self.next


def answers(blocks: DataFrame, known: DataFrame, value: str) -> DataFrame:
    """of_block, pos, value of the keys of all dictionaries that are known."""
    wanted = blocks.select(F.col("block").alias("of_block"), F.posexplode("keys").alias("pos", "key"))
    return wanted.join(known.select("key", F.col(value).alias("value")), "key").select("of_block", "pos", "value")


def look_up(blocks: DataFrame, known: DataFrame, value: str, run, schema: str) -> DataFrame:
    """``run(block table, array of the value of each key of its dictionary)`` of every block; a key not known has value 0.

    blocks: block, keys (array of long) and what else ``run`` reads.  known: key (unique), and column ``value`` (long).
    """
    found = answers(blocks, known, value)

    def one(key: tuple[pa.Scalar, ...], block: pa.Table, found: pa.Table) -> pa.Table:
        values = np.zeros(len(block.column("keys")[0]), dtype=np.int64)
        values[found.column("pos").to_numpy()] = found.column("value").to_numpy()
        return run(block, values)

    return blocks.groupBy("block").cogroup(found.groupBy("of_block")).applyInArrow(one, schema)


def bucketed(df: DataFrame) -> DataFrame:
    """Write rows of blocks to a table in the shared folder, bucketed by ``block``: two such tables join without moving the blocks again."""
    spark = df.sparkSession
    name = f"blocks_{uuid.uuid4().hex}"
    (df.write.format("parquet").option("compression", "zstd").option("path", f"{shared_folder(spark)}/{name}")
     .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").saveAsTable(name))
    return spark.table(name)


def with_answers(blocks: DataFrame, known: DataFrame, value: str) -> DataFrame:
    """The blocks (``bucketed``) with column ``known``: packed values of the keys of the dictionary, 0 for a key that isn't known and
    cut after the last one that is.  Only dictionary rows are shuffled."""

    def one(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
        pos = found.column("pos").to_numpy()
        values = np.zeros(pos.max() + 1, dtype=np.int64)
        values[pos] = found.column("value").to_numpy()
        return pa.table({"block": pa.array([key[0].as_py()]), "known": int_list(values)})

    lists = bucketed(answers(blocks, known, value).groupBy("of_block").applyInArrow(one, "block long, known array<long>"))
    return blocks.join(lists.hint("shuffle_hash"), "block", "left")


def int_list(values) -> pa.Array:
    """One row that holds all the values."""
    values = np.asarray(values, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def packed(values) -> pa.Array:
    """One row of bytes: the values as 32-bit integers, all their lowest bytes first, as that compresses well."""
    values = np.ascontiguousarray(values, dtype="<i4")
    return pa.array([values.view(np.uint8).reshape(-1, 4).T.tobytes()], pa.binary())


def unpacked(column) -> np.ndarray:
    planes = np.frombuffer(column[0].as_buffer(), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel().astype(np.int64)
