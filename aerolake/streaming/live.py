"""Streaming forms of the position dedup, hourly traffic and flight sessions.

Event time is ``event_datetime``; the watermark bounds state: late rows beyond it are dropped
and finished windows are emitted once (append mode).  Distinct aircraft use
``approx_count_distinct`` (exact distinct is not supported on streams).  Sessions here use
elapsed time (``session_window``), not minute boundaries as the batch ``sessions`` query does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.functions.time import EPOCH
from aerolake.operators import positions as P


def _event_time(df: DataFrame, col: str = "event_datetime") -> DataFrame:
    """Watermarks need a TIMESTAMP column; an NTZ wall clock is read as UTC (zone-free)."""
    if dict(df.dtypes).get(col) == "timestamp_ntz":
        micros = F.timestamp_diff("MICROSECOND", F.expr(EPOCH), F.col(col))
        return df.withColumn("_event_time", F.timestamp_micros(micros))
    return df.withColumn("_event_time", F.col(col))


def dedup_stream(positions: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drop repeated (icao24, event_timestamp) observations that arrive within the watermark."""
    p = _event_time(positions).withWatermark("_event_time", delay)
    return p.dropDuplicatesWithinWatermark(["icao24", "event_timestamp"])


def clean_positions_stream(raw: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Streaming bronze: the batch row-level normalisation, then one row per (icao24,
    event_timestamp) among rows arriving within the watermark (the first to arrive wins; the
    batch job keeps the earliest event time, which agrees whenever copies arrive in order)."""
    typed = _event_time(P.normalise_positions(raw)).withWatermark("_event_time", delay)
    deduped = typed.dropDuplicatesWithinWatermark(["icao24", "event_timestamp"])
    return P.derive_position_columns(deduped, keep=("_event_time",))


def hourly_from_clean_stream(clean: DataFrame) -> DataFrame:
    """Hourly positions / approximate distinct aircraft over ``clean_positions_stream`` output
    (its watermarked ``_event_time`` closes the hours)."""
    g = clean.groupBy(F.window("_event_time", "1 hour").alias("w")).agg(
        F.count(F.lit(1)).alias("position_count"),
        F.approx_count_distinct("icao24").alias("unique_aircraft_approx"),
        F.count_if(F.col("on_ground") == 0).alias("airborne_positions"),
    )
    return g.select(F.col("w.start").alias("hour_start"), F.col("w.end").alias("hour_end"),
                    "position_count", "unique_aircraft_approx", "airborne_positions")


def hourly_traffic_stream(positions: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Positions, approximate distinct aircraft and airborne count per event-time hour."""
    p = dedup_stream(positions, delay)
    g = p.groupBy(F.window("_event_time", "1 hour").alias("w")).agg(
        F.count(F.lit(1)).alias("position_count"),
        F.approx_count_distinct("icao24").alias("unique_aircraft_approx"),
        F.count_if(F.col("on_ground") == 0).alias("airborne_positions"),
    )
    return g.select(F.col("w.start").alias("hour_start"), F.col("w.end").alias("hour_end"),
                    "position_count", "unique_aircraft_approx", "airborne_positions")


def sessions_stream(positions: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Flight sessions per aircraft closed by ``gap`` of silence (elapsed time)."""
    p = _event_time(positions).withWatermark("_event_time", delay)
    g = p.groupBy("icao24", F.session_window("_event_time", gap).alias("s")).agg(
        F.count(F.lit(1)).alias("positions"))
    return g.select("icao24", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    "positions")
