"""The five gold aggregates over fact_aircraft_positions (partial + final hash aggregation)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.functions.numeric import pct, round_half_up
from aerolake.functions.time import date_key


def _status_count(status: str) -> F.Column:
    return F.count_if(F.col("on_ground_status") == status)


def agg_daily_traffic(fact: DataFrame) -> DataFrame:
    g = fact.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("position_count"),
        F.count_distinct("aircraft_key").alias("unique_aircraft"),
        _status_count("AIRBORNE").alias("airborne_positions"),
        _status_count("ON GROUND").alias("on_ground_positions"),
        _status_count("UNKNOWN").alias("unknown_positions"),
    )
    return g.select(
        "event_date", date_key("event_date").alias("date_key"), "position_count", "unique_aircraft",
        "airborne_positions", "on_ground_positions", "unknown_positions",
        pct("airborne_positions", "position_count").alias("airborne_percent"),
    )


def agg_hourly_traffic(fact: DataFrame) -> DataFrame:
    g = fact.groupBy("event_date", "event_hour").agg(
        F.count(F.lit(1)).alias("position_count"),
        F.count_distinct("aircraft_key").alias("unique_aircraft"),
        _status_count("AIRBORNE").alias("airborne_positions"),
        _status_count("ON GROUND").alias("on_ground_positions"),
    )
    return g.select(
        "event_date", date_key("event_date").alias("date_key"), F.col("event_hour").alias("time_key"),
        "position_count", "unique_aircraft", "airborne_positions", "on_ground_positions",
    )


def agg_altitude_distribution(fact: DataFrame) -> DataFrame:
    g = fact.groupBy("event_date", "altitude_band").agg(
        F.count(F.lit(1)).alias("position_count"),
        F.count_distinct("aircraft_key").alias("unique_aircraft"),
        F.avg("altitude_ft").alias("_avg"),
        F.min("altitude_ft").alias("_min"),
        F.max("altitude_ft").alias("_max"),
    )
    return g.select(
        "event_date", date_key("event_date").alias("date_key"), "altitude_band", "position_count",
        "unique_aircraft",
        round_half_up("_avg", 2).alias("avg_altitude_ft"),
        round_half_up("_min", 2).alias("min_altitude_ft"),
        round_half_up("_max", 2).alias("max_altitude_ft"),
    )


def agg_traffic_grid(fact: DataFrame) -> DataFrame:
    """0.1-degree cells per date. The cell key is computed once in a projection below the
    aggregate so the shuffle carries two doubles, not the raw coordinates."""
    cells = fact.select(
        "event_date", "aircraft_key", "altitude_ft",
        round_half_up("latitude", 1).alias("latitude_grid"),
        round_half_up("longitude", 1).alias("longitude_grid"),
    )
    g = cells.groupBy("event_date", "latitude_grid", "longitude_grid").agg(
        F.count(F.lit(1)).alias("position_count"),
        F.count_distinct("aircraft_key").alias("unique_aircraft"),
        F.avg("altitude_ft").alias("_avg"),
    )
    return g.select(
        "event_date", date_key("event_date").alias("date_key"), "latitude_grid", "longitude_grid",
        "position_count", "unique_aircraft", round_half_up("_avg", 2).alias("avg_altitude_ft"),
    )


def agg_aircraft_activity(fact: DataFrame) -> DataFrame:
    """Per aircraft and date.  COUNT(DISTINCT event_date) inside a group keyed by event_date is
    1 for every non-NULL date, so it is derived after the aggregate instead of expanding a
    distinct aggregation."""
    g = fact.groupBy("aircraft_key", "event_date").agg(
        F.count(F.lit(1)).alias("position_count"),
        _status_count("AIRBORNE").alias("airborne_positions"),
        _status_count("ON GROUND").alias("on_ground_positions"),
        F.avg("altitude_ft").alias("_avg"),
        F.min("altitude_ft").alias("min_altitude_ft"),
        F.max("altitude_ft").alias("max_altitude_ft"),
    )
    return g.select(
        "aircraft_key", "event_date", date_key("event_date").alias("date_key"), "position_count",
        F.when(F.col("event_date").isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("long").alias("active_days"),
        "airborne_positions", "on_ground_positions",
        round_half_up("_avg", 2).alias("avg_altitude_ft"), "min_altitude_ft", "max_altitude_ft",
    )
