"""Exact distinct aircraft that add up: bitmaps over dense aircraft numbers.

``count_distinct`` per hour can't be added up to days.  Here each (date, hour) keeps a bitmap of the aircraft seen, cut
into pieces of 32,768 numbers; pieces are OR-ed for any coarser period, and the bits of the result are its exact number of aircraft.  A late
hour only needs its own bitmap made anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Hash buckets in which keys are numbered; a key's number is its place in its bucket after the sizes of the buckets before.
BUCKETS = 256


def dense_numbers(keys: DataFrame, key: str, number: str = "number") -> DataFrame:
    """``key`` and its number 0, 1, 2, ... of the distinct keys: row numbers within hash buckets plus a prefix sum over bucket sizes."""
    placed = keys.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))
    sizes = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    ahead = sizes.alias("a").join(sizes.alias("b"), F.col("b._bucket") < F.col("a._bucket"), "left") \
        .groupBy(F.col("a._bucket").alias("_of")).agg(F.coalesce(F.sum("b._n"), F.lit(0)).alias("_ahead"))  # BUCKETS rows at most on either side
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(key)) - 1
    return placed.withColumn("_inside", inside).join(F.broadcast(ahead), F.col("_bucket") == F.col("_of")) \
        .select(key, (F.col("_ahead") + F.col("_inside")).cast("long").alias(number))


def hourly_bitmaps(positions: DataFrame, numbers: DataFrame, key: str = "icao24") -> DataFrame:
    """event_date, event_hour, piece, seen: bitmaps of the numbered aircraft with a position in that hour."""
    there = positions.select("event_date", "event_hour", key).distinct().join(numbers, key)
    return there.groupBy("event_date", "event_hour", F.bitmap_bucket_number("number").alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("seen"))


def merged(bitmaps: DataFrame, *by: str) -> DataFrame:
    """Bitmaps of a coarser period."""
    return bitmaps.groupBy(*by, "piece").agg(F.bitmap_or_agg("seen").alias("seen"))


def unique_counts(bitmaps: DataFrame, *by: str) -> DataFrame:
    """Number of aircraft per period of the bitmaps."""
    return bitmaps.groupBy(*by).agg(F.sum(F.bitmap_count("seen")).alias("unique_aircraft"))


def unique_aircraft(positions: DataFrame, numbers: DataFrame, key: str = "icao24") -> DataFrame:
    """period ('hour', 'day', 'month', 'all'), first date and hour of the period, unique_aircraft: all from the hourly bitmaps."""
    hours = hourly_bitmaps(positions, numbers, key)
    days = merged(hours, "event_date")
    months = merged(days.withColumn("event_date", F.trunc("event_date", "month")), "event_date")
    none, no_date = F.lit(None).cast("int").alias("event_hour"), F.lit(None).cast("date").alias("event_date")

    def row(period: str, counted: DataFrame, *columns) -> DataFrame:
        return counted.select(F.lit(period).alias("period"), *columns, "unique_aircraft")

    return (row("hour", unique_counts(hours, "event_date", "event_hour"), "event_date", "event_hour")
            .unionAll(row("day", unique_counts(days, "event_date"), "event_date", none))
            .unionAll(row("month", unique_counts(months, "event_date"), "event_date", none))
            .unionAll(row("all", unique_counts(merged(months)).filter("unique_aircraft IS NOT NULL"), no_date, none)))
