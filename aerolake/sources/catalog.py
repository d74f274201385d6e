"""Tables of the session's catalog: created from a declared schema, filled by column name, bucketed for window work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.functions.time import hour_index
from aerolake.sources.sinks import align_by_name

#: Column by which bucketed positions keep one (aircraft, hour) together.
HOUR = "event_hour_index"


def _quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def create_table(spark: SparkSession, name: str, schema: T.StructType, partition_cols: Sequence[str] = (), location: str | None = None) -> None:
    """Create a Parquet table of the declared columns unless there is one; ``location`` makes it an external one."""
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(map(_quoted, partition_cols))})" if partition_cols else ""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({columns}) USING parquet{parts}{where}")


def insert_by_name(batch: DataFrame, name: str) -> None:
    """Append a batch to a catalog table.  Columns are matched by name whatever their case; those that the batch lacks are
    NULL, those that the table lacks are left out, types are cast."""
    spark = batch.sparkSession
    rows = align_by_name(batch, spark.table(_quoted(name)).schema)
    spark.sql(f"INSERT INTO {_quoted(name)} BY NAME SELECT * FROM {{rows}}", rows=rows)


def publish(spark: SparkSession, database: str, name: str, path: str, partition_cols: Sequence[str] = ()) -> None:
    """An external table over a written layer, with the schema of its files and the partitions that its folders have now."""
    full = f"{database}.{name}"
    if spark.catalog.tableExists(full):
        spark.sql(f"DROP TABLE {_quoted(full)}")  # external: files stay
    create_table(spark, full, spark.read.parquet(path).schema, partition_cols, location=path)
    if partition_cols:
        spark.catalog.recoverPartitions(_quoted(full))


def save_bucketed_positions(positions: DataFrame, name: str, buckets: int, key: str = "icao24", ts: str = "event_datetime") -> None:
    """Replace a catalog table of positions by these, bucketed by (aircraft, hour) and sorted by time within.

    Buckets of aircraft alone would put an aircraft with a third of all rows into one file and one task; its hours spread over all
    buckets, and windows by (aircraft, hour) still need no exchange.  Each bucket is written by one task.
    """
    hours = positions.withColumn(HOUR, hour_index(ts))
    (hours.repartition(buckets, F.col(key), F.col(HOUR)).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, key, HOUR).sortBy(key, HOUR, ts).saveAsTable(name))
