"""Dataset profiles: per-column row and NULL counts in one aggregate pass, before/after
comparison of two layers, and a schema listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def profile(df: DataFrame) -> DataFrame:
    """(column_name, ordinal, total_rows, null_count): one scan, one tiny result per column."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', {i + 1}, _n{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, ordinal, null_count)", "_rows") \
        .select("column_name", F.col("ordinal").cast("int"), F.col("_rows").alias("total_rows"),
                F.col("null_count").cast("long"))


def compare_profiles(before: DataFrame, after: DataFrame) -> DataFrame:
    """Profiles of two layers side by side, matched on column name (columns only in one side
    keep NULLs for the other)."""
    b = profile(before).select("column_name", F.col("total_rows").alias("rows_before"),
                               F.col("null_count").alias("nulls_before"))
    a = profile(after).select("column_name", F.col("total_rows").alias("rows_after"),
                              F.col("null_count").alias("nulls_after"))
    return b.join(a, "column_name", "full_outer")


def schema_listing(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Name, type, nullability in ordinal order (driver-side metadata only, no data)."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    schema = T.StructType([T.StructField("ordinal", T.IntegerType()), T.StructField("column_name", T.StringType()),
                           T.StructField("data_type", T.StringType()), T.StructField("nullable", T.BooleanType())])
    return spark.createDataFrame(rows, schema)


def row_counts(**layers: DataFrame) -> DataFrame:
    """One row with the row count of each named layer (each a global aggregate, cross-joined)."""
    out = None
    for name, df in layers.items():
        c = df.agg(F.count(F.lit(1)).alias(name))
        out = c if out is None else out.crossJoin(c)
    return out
