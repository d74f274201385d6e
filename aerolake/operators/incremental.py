"""Keyed incremental merge (upsert) for Parquet tables without MERGE support.

``upsert_by_key`` is a pure DataFrame function; ``commit_version`` writes the merged table to
a new version folder (never overwriting the folder being read) and ``read_latest`` reads the
newest committed version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def newer_than_target(existing: DataFrame, batch: DataFrame, high_water_col: str) -> DataFrame:
    """Batch rows whose ``high_water_col`` exceeds the target's maximum.  An empty target (NULL
    maximum) admits everything.  The maximum is a one-row aggregate joined by broadcast: no
    driver round trip."""
    hw = existing.agg(F.max(high_water_col).alias("_hw"))
    b = batch.crossJoin(F.broadcast(hw))
    return b.filter(F.col("_hw").isNull() | (F.col(high_water_col) > F.col("_hw"))).drop("_hw")


def upsert_by_key(existing: DataFrame, batch: DataFrame, keys: list[str], high_water_col: str | None = None,
                  order_within_batch: list | None = None) -> DataFrame:
    """Replace rows of ``existing`` whose key appears in ``batch`` and add new keys.

    Keys compare NULL-safely.  If the batch repeats a key, the first row by
    ``order_within_batch`` wins (default: highest ``high_water_col``).
    """
    if high_water_col is not None:
        batch = newer_than_target(existing, batch, high_water_col)
    order = order_within_batch or ([F.col(high_water_col).desc_nulls_last()] if high_water_col else [F.lit(1)])
    batch = batch.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))) \
        .filter(F.col("_rn") == 1).drop("_rn")
    bk = batch.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    cond = None
    for k in keys:
        e = existing[k].eqNullSafe(bk[f"_k_{k}"])
        cond = e if cond is None else cond & e
    kept = existing.join(bk, cond, "left_anti")
    return kept.unionByName(batch.select(*existing.columns))


def filesystem(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = filesystem(spark, path)
    return fs.exists(p)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Is there any path of this pattern?"""
    fs, p = filesystem(spark, pattern)
    return bool(len(fs.globStatus(p) or []))


def partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column that have a folder under ``path``."""
    fs, p = filesystem(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder."""
    fs, p = filesystem(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete table folders (partitions that have no rows any more)."""
    for path in paths:
        fs, p = filesystem(spark, path)
        fs.delete(p, True)


def list_versions(spark: SparkSession, base: str, committed_only: bool = True) -> list[int]:
    """Version numbers under ``base``; by default only committed ones (with ``_SUCCESS``)."""
    fs, p = filesystem(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("version="):
            v = name.split("=", 1)[1]
            if v.isdigit() and (not committed_only or fs.exists(st.getPath().suffix("/_SUCCESS"))):
                out.append(int(v))
    return sorted(out)


def next_version(spark: SparkSession, base: str) -> int:
    """A number past every folder, committed or not: a run that died mid-write leaves a folder without
    _SUCCESS, which readers ignore and the next attempt must not collide with."""
    versions = list_versions(spark, base, committed_only=False)
    return (versions[-1] + 1) if versions else 1


def version_path(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/version={version:06d}"


def commit_version(spark: SparkSession, df: DataFrame, base: str, version: int | None = None) -> str:
    """Write ``df`` as the next version of the table at ``base``; readers of the previous
    version are never disturbed (stage-and-swap by versioned folders, committed by _SUCCESS)."""
    target = version_path(base, version or next_version(spark, base))
    df.write.mode("error").parquet(target)
    return target


def read_latest(spark: SparkSession, base: str, schema=None) -> DataFrame | None:
    versions = list_versions(spark, base)
    if not versions:
        return None
    r = spark.read
    return (r.schema(schema) if schema is not None else r).parquet(version_path(base, versions[-1]))
