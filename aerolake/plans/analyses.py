"""The analysis and QA statements of the source project, one function per statement.

Each takes a ``Models`` and returns a lazy DataFrame.  Every top-k carries a total tie-break so
results are reproducible; every global window runs on an aggregated, bounded frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.functions.numeric import round_half_up
from aerolake.functions.text import upper_trim
from aerolake.functions.time import hour_index
from aerolake.operators import windows as W
from aerolake.plans.catalog import Models


def _n() -> F.Column:
    return F.count(F.lit(1))


# ---- flights (Track 1) ---------------------------------------------------------------------
def q02_01_count(m: Models) -> DataFrame:
    return m.flights_raw.agg(_n().alias("total_rows"))


def q02_02_snapshot_summary(m: Models) -> DataFrame:
    """Snapshot table stand-in: events, user_id as aircraft, hour of ts (epoch s) as snapshot."""
    ev = m.table("events", ["user_id", "ts"])
    snap = (hour_index("ts") * 3600).cast("long")
    s = ev.select(F.col("user_id").alias("icao24"), snap.alias("snapshot_time"))
    return s.agg(
        _n().alias("total_rows"),
        F.count_distinct("icao24").alias("unique_aircraft"),
        F.count_distinct("snapshot_time").alias("snapshots"),
        F.min("snapshot_time").alias("first_snapshot"),
        F.max("snapshot_time").alias("last_snapshot"),
    )


def q02_03_sample(m: Models) -> DataFrame:
    s = m.stg_flights.drop("_loaded_at")
    return s.orderBy("flight_callsign", "aircraft_id", "departure_time", "arrival_time",
                     "departure_horiz_distance_m", "arrival_horiz_distance_m").limit(10)


def q02_04_fct_count(m: Models) -> DataFrame:
    return m.flight_base.agg(_n().alias("total_rows"))


def _departures_by_airport(m: Models) -> DataFrame:
    """Per departure airport: departures and mean duration.  The fact is reduced to one row per
    airport key first (partial aggregation), then joined to the dimension: both join sides are
    bounded by the number of airports."""
    per_key = m.flight_base.groupBy("departure_airport_key").agg(
        _n().alias("num_departures"),
        F.sum("flight_duration_minutes").alias("_dur_sum"),
        F.count("flight_duration_minutes").alias("_dur_n"),
    )
    a = m.dim_airports
    j = per_key.join(a, per_key["departure_airport_key"] == a["airport_key"], "inner")
    return j.groupBy("airport_code").agg(
        F.sum("num_departures").alias("num_departures"),
        (F.sum("_dur_sum").cast("double") / F.sum("_dur_n")).alias("avg_duration_min"),
    )


def q02_05_top_airports(m: Models) -> DataFrame:
    return _departures_by_airport(m).orderBy(F.col("num_departures").desc(), F.col("airport_code")).limit(10)


def q02_06_flight_kpis(m: Models) -> DataFrame:
    return m.flight_base.agg(
        _n().alias("total_flights"),
        F.count_distinct("aircraft_id").alias("unique_aircraft"),
        F.count_distinct("departure_airport_key").alias("departure_airports"),
        F.count_distinct("arrival_airport_key").alias("arrival_airports"),
        round_half_up(F.avg("flight_duration_minutes"), 2).alias("avg_duration_minutes"),
        F.max("flight_duration_minutes").alias("max_duration_minutes"),
    )


def q02_07_time_range(m: Models) -> DataFrame:
    return m.flight_base.agg(F.min("departure_time").alias("first_flight"),
                             F.max("departure_time").alias("last_flight"))


def q02_08_key_coverage(m: Models) -> DataFrame:
    return m.flight_base.agg(
        _n().alias("total_rows"),
        F.count("departure_airport_key").alias("flights_with_departure"),
        F.count("arrival_airport_key").alias("flights_with_arrival"),
        F.count("departure_date_key").alias("flights_with_date"),
    )


def q02_09_missing_keys(m: Models) -> DataFrame:
    return m.flight_base.agg(
        _n().alias("total_rows"),
        F.count_if(F.col("departure_airport_key").isNull()).alias("missing_departure_key"),
        F.count_if(F.col("arrival_airport_key").isNull()).alias("missing_arrival_key"),
    )


def q02_10_missing_airports(m: Models) -> DataFrame:
    return m.stg_flights.agg(
        _n().alias("total_rows"),
        F.count_if(F.col("departure_airport").isNull()).alias("missing_departure_airport"),
        F.count_if(F.col("arrival_airport").isNull()).alias("missing_arrival_airport"),
    )


def q05_7_airport_rank(m: Models) -> DataFrame:
    per_airport = _departures_by_airport(m).select("airport_code", "num_departures")
    shared = W.share_of_total(per_airport, "num_departures")
    return W.rank_top_k(shared, "num_departures", 10, ["airport_code"]).select(
        "airport_code", "num_departures", "rank", "pct_of_total")


# ---- positions: bronze (= cleaned output) -------------------------------------------------
def q03_01_count(m: Models) -> DataFrame:
    return m.clean_positions.agg(_n().alias("total_rows"))


def q04_01_sample(m: Models) -> DataFrame:
    return m.clean_positions.orderBy("icao24", "event_timestamp").limit(10)


def q04_02_event_range(m: Models) -> DataFrame:
    return m.clean_positions.agg(F.min("event_datetime").alias("first_event"),
                                 F.max("event_datetime").alias("last_event"))


def q04_03_daily_rows(m: Models) -> DataFrame:
    return m.clean_positions.groupBy(F.to_date("event_datetime").alias("event_date")) \
        .agg(_n().alias("total_rows")).orderBy("event_date")


def q04_04_aircraft(m: Models) -> DataFrame:
    return m.clean_positions.agg(F.count_distinct("icao24").alias("unique_aircraft"))


def q04_05_nulls(m: Models) -> DataFrame:
    c = m.clean_positions
    return c.agg(
        _n().alias("total_rows"),
        F.count_if(F.col("icao24").isNull()).alias("null_icao24"),
        F.count_if(F.col("event_datetime").isNull()).alias("null_event_datetime"),
        F.count_if(F.col("latitude").isNull()).alias("null_latitude"),
        F.count_if(F.col("longitude").isNull()).alias("null_longitude"),
        F.count_if(F.col("altitude_ft").isNull()).alias("null_altitude"),
    )


def q04_06_geo_extent(m: Models) -> DataFrame:
    return m.clean_positions.agg(
        F.min("latitude").alias("min_lat"), F.max("latitude").alias("max_lat"),
        F.min("longitude").alias("min_lon"), F.max("longitude").alias("max_lon"),
    )


def q04_07_ground(m: Models) -> DataFrame:
    return m.clean_positions.groupBy("on_ground").agg(_n().alias("total_rows")).orderBy("on_ground")


def q04_08_bands(m: Models) -> DataFrame:
    return m.clean_positions.groupBy("altitude_band").agg(_n().alias("total_rows")).orderBy("altitude_band")


def q04_09_altitude_stats(m: Models) -> DataFrame:
    return m.clean_positions.filter(F.col("altitude_ft").isNotNull()).agg(
        F.min("altitude_ft").alias("min_altitude"),
        F.max("altitude_ft").alias("max_altitude"),
        F.avg("altitude_ft").alias("avg_altitude"),
    )


def q04_10_ground_extent(m: Models) -> DataFrame:
    return m.clean_positions.groupBy("on_ground").agg(
        _n().alias("total_rows"),
        F.min("latitude").alias("min_lat"), F.max("latitude").alias("max_lat"),
        F.min("longitude").alias("min_lon"), F.max("longitude").alias("max_lon"),
    ).orderBy("on_ground")


def q04_11_unexpected_ground(m: Models) -> DataFrame:
    """Spot check of 30 rows with ground code 2 or 3 (only 0/1 expected)."""
    return m.clean_positions.filter(F.col("on_ground").isin(2, 3)).select(
        "icao24", "registration", "callsign", "on_ground", "latitude", "longitude", "altitude_ft",
        "event_datetime", "event_timestamp",
    ).orderBy("icao24", "event_timestamp").limit(30).drop("event_timestamp")


# ---- positions: silver QA ----------------------------------------------------------------
def q04_12_silver_summary(m: Models) -> DataFrame:
    s = m.stg_positions

    def nulls(c):
        return F.count_if(F.col(c).isNull())

    return s.agg(
        _n().alias("total_rows"),
        F.count_distinct("icao24").alias("unique_aircraft"),
        F.count_distinct("event_date").alias("days"),
        nulls("icao24").alias("null_icao24"),
        nulls("event_datetime").alias("null_event_datetime"),
        nulls("latitude").alias("null_latitude"),
        nulls("longitude").alias("null_longitude"),
        nulls("registration").alias("null_registration"),
        nulls("callsign").alias("null_callsign"),
        nulls("squawk").alias("null_squawk"),
        F.min("latitude").alias("min_latitude"), F.max("latitude").alias("max_latitude"),
        F.min("longitude").alias("min_longitude"), F.max("longitude").alias("max_longitude"),
        F.min("event_datetime").alias("first_event"), F.max("event_datetime").alias("last_event"),
    )


def q04_13_wrong_date(m: Models) -> DataFrame:
    s = m.stg_positions
    return s.agg(F.count_if(F.col("event_date") != F.to_date("event_datetime")).alias("wrong_event_date"))


def q04_14_lowercase(m: Models) -> DataFrame:
    return m.stg_positions.agg(F.count_if(F.col("icao24") != F.upper("icao24")).alias("lowercase_icao24"))


def q04_15_spaces(m: Models) -> DataFrame:
    return m.stg_positions.agg(F.count_if(F.col("icao24") != F.trim("icao24")).alias("icao24_with_spaces"))


def q04_16_bad_key(m: Models) -> DataFrame:
    return m.stg_positions.agg(F.count_if(F.col("icao24") != upper_trim("icao24")).alias("bad_icao24"))


def q04_17_ground_mapping(m: Models) -> DataFrame:
    return m.stg_positions.groupBy("on_ground", "on_ground_flag", "on_ground_status") \
        .agg(_n().alias("total_rows")).orderBy("on_ground")


def q04_18_band_summary(m: Models) -> DataFrame:
    return m.stg_positions.groupBy("altitude_band").agg(
        _n().alias("total_rows"),
        F.min("altitude_ft").alias("min_altitude"),
        F.max("altitude_ft").alias("max_altitude"),
    ).orderBy("altitude_band")


def q04_19_duplicates(m: Models) -> DataFrame:
    d = m.stg_positions.groupBy("icao24", "event_timestamp").agg(_n().alias("duplicate_count")) \
        .filter(F.col("duplicate_count") > 1)
    return d.orderBy(F.col("duplicate_count").desc(), "icao24", "event_timestamp").limit(20)


def q04_20_orphan_dates(m: Models) -> DataFrame:
    """Fact date keys missing from dim_dates.  Distinct keys first, then the anti join: both
    sides are bounded by the number of dates."""
    keys = m.fact_positions.groupBy("date_key").agg(_n().alias("rows_count"))
    orphans = keys.join(m.dim_dates.select("date_key"), "date_key", "left_anti")
    return orphans.orderBy("date_key")


# ---- advanced analytics --------------------------------------------------------------------
def q05_1_most_active(m: Models) -> DataFrame:
    per = m.stg_positions.groupBy("icao24").agg(
        F.min("registration").alias("registration"),   # ANY_VALUE, made reproducible
        F.min("callsign").alias("callsign"),
        _n().alias("total_positions"),
        round_half_up(F.avg("altitude_ft"), 0).alias("avg_altitude_ft"),
    )
    top = W.rank_top_k(per, "total_positions", 15, ["icao24"])
    return top.select("rank", "icao24", "registration", "callsign", "total_positions", "avg_altitude_ft")


def q05_2_hourly_share(m: Models) -> DataFrame:
    per = m.stg_positions.groupBy("event_hour").agg(_n().alias("total_positions"))
    return W.share_of_total(per, "total_positions").orderBy("event_hour")


def q05_3_day_over_day(m: Models) -> DataFrame:
    daily = m.stg_positions.groupBy("event_date").agg(_n().alias("total_rows"))
    return W.day_over_day(daily, "event_date", "total_rows").orderBy("event_date")


def q05_4_band_pareto(m: Models) -> DataFrame:
    per = m.stg_positions.groupBy("altitude_band").agg(_n().alias("total_rows"))
    shared = W.share_of_total(per, "total_rows", keep_total="_total")
    return W.running_share(shared, "total_rows", total_col="_total").drop("_total") \
        .orderBy(F.col("total_rows").desc(), "altitude_band")


def q05_5_peak_airborne(m: Models) -> DataFrame:
    s = m.stg_positions.filter(F.col("on_ground_flag") == F.lit(False))
    per = s.groupBy("event_date", "event_hour").agg(F.count_distinct("icao24").alias("aircraft_in_air"))
    return per.orderBy(F.col("aircraft_in_air").desc(), "event_date", "event_hour").limit(10)


def q05_6_gaps(m: Models) -> DataFrame:
    g = W.detect_gaps(m.stg_positions, "icao24", "event_datetime", 30)
    return g.orderBy(F.col("minutes_since_last").desc(), "icao24", "event_datetime").limit(20)


def sessions(m: Models) -> DataFrame:
    return W.sessions(m.stg_positions, "icao24", "event_datetime", 30)


# Backfill slices over events.ts (FIXTURES.md B3): five 2-hour windows, one day apart,
# counting back from a fixed anchor.
SLICE_ANCHOR = "2024-01-31 00:00:00"
SLICE_COUNT = 5


def slice_windows(m: Models) -> DataFrame:
    ev = m.table("events", ["event_id", "ts", "user_id", "event_type"])
    return W.slice_windows(ev, "ts", SLICE_ANCHOR, SLICE_COUNT, days_back=1, width_s=7200)
