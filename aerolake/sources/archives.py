"""Tar archives of gzipped trace JSON, read in parallel with ``mapInPandas``.

Two stages, so that one huge archive is not decompressed by a single task:

1. ``list_members``: per archive, walk the tar headers only (``tarfile`` in random-access mode
   seeks over member data), emitting (archive, member, offset, size, piece) for members named
   ``./traces/*.json``; a piece is a run of members of about ``PIECE_BYTES``, from the running sum of their sizes.
2. ``read_members``: pieces are dealt over as many tasks as their bytes ask for; each task seeks to its byte
   ranges, reads and gunzips them, with one archive open at a time.  A member that fails to decompress
   yields an error row, and ``parse_documents`` adds one for each that isn't a JSON trace document.

The driver only lists archive paths and sees the sum of sizes; no archive content and no member list passes through it.
"""

from __future__ import annotations

import gzip
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.schemas import RAW_TRACE

MEMBER_PREFIX, MEMBER_SUFFIX = "./traces/", ".json"
MEMBERS_SCHEMA = "archive string, member string, offset long, size long, piece long, error string"
DOCS_SCHEMA = "archive string, member string, doc string, error string"
BATCH_ROWS = 512
#: Compressed bytes of a piece and of a task.
PIECE_BYTES, TASK_BYTES = 4 << 20, 32 << 20


def _open(path: str):
    """Open a local or Hadoop-compatible path as a seekable binary stream."""
    if "://" in path and not path.startswith("file:"):
        import fsspec  # optional; present on clusters that read object stores from Python
        return fsspec.open(path, "rb").open()
    return open(path.replace("file://", "").replace("file:", ""), "rb")


def _wanted(name: str) -> bool:
    return name.startswith(MEMBER_PREFIX) and name.endswith(MEMBER_SUFFIX)


def _list_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cols = ["archive", "member", "offset", "size", "piece", "error"]
    out: list[tuple] = []
    for pdf in batches:
        for path in pdf["path"]:
            total = 0
            try:
                with _open(path) as fh, tarfile.open(fileobj=fh, mode="r:") as tar:
                    while (m := tar.next()) is not None:
                        if m.isfile() and _wanted(m.name):
                            out.append((path, m.name, m.offset_data, m.size, total // PIECE_BYTES, None))
                            total += m.size
                        tar.members = []   # headers only; do not accumulate TarInfo objects
                        if len(out) >= BATCH_ROWS * 8:
                            yield pd.DataFrame(out, columns=cols)
                            out = []
            except Exception as exc:  # noqa: BLE001 - unreadable archive -> one error row
                out.append((path, None, None, None, None, f"{type(exc).__name__}: {exc}"))
    if out:
        yield pd.DataFrame(out, columns=cols)


def _read_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cols = ["archive", "member", "doc", "error"]
    fh, opened = None, None  # rows come sorted by archive
    out: list[tuple] = []
    try:
        for pdf in batches:
            for archive, member, offset, size, error in pdf[["archive", "member", "offset", "size", "error"]].itertuples(index=False):
                if error is not None or member is None:
                    out.append((archive, member, None, error))
                    continue
                try:
                    if opened != archive:
                        if fh is not None:
                            fh.close()
                        fh, opened = None, None
                        fh, opened = _open(archive), archive
                    fh.seek(int(offset))
                    out.append((archive, member, gzip.decompress(fh.read(int(size))).decode("utf-8"), None))
                except Exception as exc:  # noqa: BLE001 - corrupt member -> error row
                    out.append((archive, member, None, f"{type(exc).__name__}: {exc}"))
                if len(out) >= BATCH_ROWS:
                    yield pd.DataFrame(out, columns=cols)
                    out = []
        if out:
            yield pd.DataFrame(out, columns=cols)
    finally:
        if fh is not None:
            fh.close()


def list_archives(spark: SparkSession, path: str, pattern: str = "*.tar") -> DataFrame:
    """Archive paths under ``path`` (file listing through the data source, no contents read)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", True).load(path).select(F.col("path")))


def list_members(spark: SparkSession, paths: DataFrame | list[str]) -> DataFrame:
    """(archive, member, offset, size, piece, error) for every trace member; one archive per task,
    headers only."""
    if isinstance(paths, list):
        paths = spark.createDataFrame([(p,) for p in paths], "path string")
    n = max(1, spark.sparkContext.defaultParallelism)
    return paths.repartition(n, "path").mapInPandas(_list_members, MEMBERS_SCHEMA)


def tasks_for(members: DataFrame, task_bytes: int = TASK_BYTES) -> int:
    """Number of tasks that the bytes of the members ask for."""
    return max(1, -(-(members.agg(F.sum("size")).first()[0] or 0) // task_bytes))


def read_members(members: DataFrame, tasks: int) -> DataFrame:
    """(archive, member, doc, error) of the listed members, each decoded once.  Pieces are spread over ``tasks`` independently of the archive
    they come from, so a hot archive is decompressed by many tasks and none gets much more bytes than others."""
    return members.repartition(tasks, "archive", "piece").sortWithinPartitions("archive", "offset").mapInPandas(_read_members, DOCS_SCHEMA)


def read_trace_archives(spark: SparkSession, paths: DataFrame | list[str]) -> DataFrame:
    """(archive, member, doc, error) for every trace member of every archive.  Without a written member list the headers are
    walked once for the sum of sizes and once for the members; ``jobs.stage_archives`` writes it."""
    members = list_members(spark, paths)
    return flag_invalid(read_members(members, tasks_for(members)))


def parse_documents(docs: DataFrame) -> DataFrame:
    """archive, member, error and the parsed trace document of each member: one JSON parse for positions and errors alike."""
    schema = T.StructType([*RAW_TRACE.fields, T.StructField("_corrupt", T.StringType())])
    parsed = docs.select("archive", "member", "error", F.from_json("doc", schema, {"columnNameOfCorruptRecord": "_corrupt"}).alias("d"), F.col("doc").isNotNull().alias("read"))
    unread = F.col("d.icao").isNull() | F.col("d.timestamp").isNull() | F.col("d.trace").isNull()
    invalid = F.col("error").isNull() & F.col("read") & (F.col("d").isNull() | (F.col("d._corrupt").isNotNull() & unread))
    return parsed.select("archive", "member", F.when(invalid, F.lit("invalid JSON document")).otherwise(F.col("error")).alias("error"),
                         *(F.col(f"d.{f.name}").alias(f.name) for f in RAW_TRACE.fields))


def flag_invalid(docs: DataFrame) -> DataFrame:
    """``docs`` with an error on each document that is no JSON, or whose header or points don't parse: such a document
    yields no positions.  One that parses, but lacks a field, is left to the guards of ``flatten_traces``."""
    schema = T.StructType([*RAW_TRACE.fields, T.StructField("_corrupt", T.StringType())])
    d = F.from_json("doc", schema, {"columnNameOfCorruptRecord": "_corrupt"})
    unread = d["icao"].isNull() | d["timestamp"].isNull() | d["trace"].isNull()
    invalid = F.col("error").isNull() & F.col("doc").isNotNull() & (d.isNull() | (d["_corrupt"].isNotNull() & unread))
    return docs.withColumn("error", F.when(invalid, F.lit("invalid JSON document")).otherwise(F.col("error")))


def ingest_counters(docs: DataFrame, positions: DataFrame) -> DataFrame:
    """Extraction counters: documents read, invalid members, distinct aircraft, rows produced."""
    d = docs.agg(F.count_if(F.col("error").isNull()).alias("documents"),
                 F.count_if(F.col("error").isNotNull()).alias("invalid_files"))
    p = positions.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("icao24").alias("aircraft"))
    return d.crossJoin(p)
