"""Readers for the driver's Parquet tables (one file or directory per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_L, _I, _D, _S, _TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()
# Declared schemas of the driver tables this library reads (no footer-reading job per read).
TABLE_SCHEMAS = {
    "events": _schema(("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S), ("value", _D),
                      ("props", _S)),
    "orders": _schema(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S), ("o_totalprice", _D),
                      ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _schema(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L), ("l_linenumber", _I),
                        ("l_quantity", _D), ("l_extendedprice", _D), ("l_discount", _D), ("l_tax", _D),
                        ("l_returnflag", _S), ("l_linestatus", _S), ("l_shipdate", _TS)),
    "customer": _schema(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I), ("c_acctbal", _D),
                        ("c_mktsegment", _S)),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read one table; selecting columns up front keeps the scan's ReadSchema narrow.  Split sizes
    are the session's (``spark.sql.files.maxPartitionBytes``)."""
    schema = TABLE_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
