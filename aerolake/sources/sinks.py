"""Sinks: Parquet (plain and date-partitioned), CSV, raw JSON by date path, load by name."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_scratch(spark: SparkSession) -> str:
    """A new folder name in the folder that all executors share (spark.checkpoint.dir); a local one only where Spark is local and none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="aerolake-scratch-")
    return f"{root.rstrip('/')}/scratch-{uuid.uuid4().hex}"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str], mode: str = "overwrite",
                      static: bool = False, max_records_per_file: int = 5_000_000) -> None:
    """Write Parquet partitioned by ``partition_cols``.

    A ``REBALANCE(partition_cols)`` hint hashes rows on the partition columns and lets AQE split a
    large partition value (a busy date) into advisory-size tasks and merge small ones, so file sizes
    follow the data.  An overwrite replaces only the partition values present in ``df``; with ``static``
    it replaces the whole folder.
    """
    (df.hint("rebalance", *partition_cols).sortWithinPartitions(*partition_cols).write.mode(mode)
     .option("partitionOverwriteMode", "static" if static else "dynamic")
     .option("maxRecordsPerFile", max_records_per_file).partitionBy(*partition_cols).parquet(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def with_date_path_columns(df: DataFrame, ts_col: str) -> DataFrame:
    """year=YYYY / month=MM / day=DD partition columns (zero padded) from a timestamp."""
    return df.withColumns({
        "year": F.date_format(ts_col, "yyyy"),
        "month": F.date_format(ts_col, "MM"),
        "day": F.date_format(ts_col, "dd"),
    })


def write_raw_partitioned(df: DataFrame, path: str, ts_col: str, mode: str = "append") -> None:
    """Raw JSON under ``year=/month=/day=`` folders; part-file names are unique per write, so
    repeated runs never collide."""
    with_date_path_columns(df, ts_col).write.mode(mode).partitionBy("year", "month", "day").json(path)


def align_by_name(batch: DataFrame, target: T.StructType) -> DataFrame:
    """Match batch columns to the target schema by name, ignoring case; target columns missing
    from the batch become NULL, extra batch columns are dropped, types are cast."""
    lower = {c.lower(): c for c in batch.columns}
    cols = []
    for f in target.fields:
        src = lower.get(f.name.lower())
        cols.append((F.col(src) if src is not None else F.lit(None)).cast(f.dataType).alias(f.name))
    return batch.select(*cols)


def canonical_case(df: DataFrame) -> DataFrame:
    """Rename every column to lower snake case (the warehouse's upper-case names fold here)."""
    return df.toDF(*[c.lower() for c in df.columns])


def load_by_name(batch: DataFrame, path: str, target: T.StructType, fmt: str = "parquet") -> None:
    """Append a batch to a table directory, matching columns by name (case-insensitive)."""
    align_by_name(batch, target).write.mode("append").format(fmt).save(path)
