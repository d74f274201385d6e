"""Track 1: flight records -> staging -> airports and calendar dimensions -> flights fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.functions.codes import surrogate_key
from aerolake.functions.time import boundary_minutes, day_of_week_sun0, from_epoch_seconds, utc_now_ntz
from aerolake.operators.windows import rank_from_histogram

STG_FLIGHT_COLUMNS = [
    "aircraft_id", "flight_callsign", "departure_airport", "arrival_airport", "departure_time",
    "arrival_time", "departure_horiz_distance_m", "arrival_horiz_distance_m", "processed_at", "_loaded_at",
]


def stage_flights(raw: DataFrame, loaded_at=None) -> DataFrame:
    """Rename projection with epoch -> NTZ timestamps.  ``_loaded_at`` is stamped once per run
    (a literal), never re-evaluated per read, so incremental high-water marks are meaningful."""
    stamp = F.lit(loaded_at).cast("timestamp_ntz") if loaded_at is not None else utc_now_ntz()
    return raw.select(
        F.col("icao24").alias("aircraft_id"),
        F.col("callsign").alias("flight_callsign"),
        F.col("estdepartureairport").alias("departure_airport"),
        F.col("estarrivalairport").alias("arrival_airport"),
        from_epoch_seconds("firstseen").alias("departure_time"),
        from_epoch_seconds("lastseen").alias("arrival_time"),
        F.col("estdepartureairporthorizdistance").alias("departure_horiz_distance_m"),
        F.col("estarrivalairporthorizdistance").alias("arrival_horiz_distance_m"),
        F.col("processed_at"),
        stamp.alias("_loaded_at"),
    )


def build_dim_airports(stg: DataFrame) -> DataFrame:
    """UNION (distinct) of departure and arrival codes with an md5 surrogate key.  The codes are
    unpivoted in one scan and de-duplicated by one partial+final aggregate."""
    codes = stg.select(F.explode(F.array("departure_airport", "arrival_airport")).alias("airport_code")) \
        .filter(F.col("airport_code").isNotNull()).distinct()
    return codes.select(surrogate_key("airport_code").alias("airport_key"), "airport_code")


def build_dim_date(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Calendar spine [start, end), one row per day: md5 key, parts, names, weekend flag."""
    days = spark.range(1).select(F.explode(F.sequence(
        F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1))).alias("date_day"))
    return calendar_columns(days)


def calendar_columns(days: DataFrame) -> DataFrame:
    dow = day_of_week_sun0("date_day")
    return days.select(
        surrogate_key("date_day").alias("date_key"),
        F.col("date_day"),
        F.year("date_day").cast("int").alias("year"),
        F.month("date_day").cast("int").alias("month"),
        F.dayofmonth("date_day").cast("int").alias("day"),
        dow.alias("day_of_week"),
        F.date_format("date_day", "EEEE").alias("day_name"),
        F.date_format("date_day", "MMMM").alias("month_name"),
        dow.isin(0, 6).alias("is_weekend"),
    )


def calendar_for(stg: DataFrame, col: str = "departure_time") -> DataFrame:
    """Calendar spanning the dates present in ``col`` (bounds by one global aggregate; the
    spine itself is generated per row of a one-row frame, no driver round trip)."""
    bounds = stg.agg(F.min(F.to_date(col)).alias("lo"), F.max(F.to_date(col)).alias("hi"))
    days = bounds.filter(F.col("lo").isNotNull()).select(F.explode(F.sequence("lo", "hi")).alias("date_day"))
    return calendar_columns(days)


FCT_COLUMNS = [
    "aircraft_id", "flight_callsign", "departure_time", "arrival_time", "departure_airport_key",
    "arrival_airport_key", "departure_date_key", "flight_duration_minutes", "processed_at", "_loaded_at",
    "row_num", "duration_rank_from_airport",
]

#: The fact without its rank, as it is stored by day.
FLIGHT_BASE = T.StructType([T.StructField(n, t) for n, t in zip(FCT_COLUMNS[:-1], (
    T.StringType(), T.StringType(), T.TimestampNTZType(), T.TimestampNTZType(), T.StringType(), T.StringType(), T.StringType(),
    T.LongType(), T.TimestampNTZType(), T.TimestampNTZType(), T.LongType()))])


def dedup_order() -> list:
    """Total order for "latest arrival wins": arrival time, then the latest load, then the remaining source columns."""
    return [
        F.col("arrival_time").desc_nulls_last(), F.col("_loaded_at").desc_nulls_last(),
        F.col("flight_callsign").asc_nulls_last(),
        F.col("departure_airport").asc_nulls_last(), F.col("arrival_airport").asc_nulls_last(),
        F.col("departure_horiz_distance_m").asc_nulls_last(), F.col("arrival_horiz_distance_m").asc_nulls_last(),
        F.col("processed_at").asc_nulls_last(),
    ]


RANK_KEYS = ["departure_airport_key", "flight_duration_minutes"]


def keyed_flights(stg: DataFrame, airports: DataFrame | None = None) -> DataFrame:
    """Staged flights of positive duration with airport keys and boundary-minute duration.

    dim_airports holds every non-NULL code of the same staging data and its key is md5(code), so
    the LEFT JOIN on code is the hash of the code when it is present.  Without a supplied
    ``airports`` frame we compute that expression and skip the join (no shuffle of the fact).
    """
    if airports is None:
        dep_key = F.when(F.col("departure_airport").isNotNull(), surrogate_key("departure_airport"))
        arr_key = F.when(F.col("arrival_airport").isNotNull(), surrogate_key("arrival_airport"))
        j = stg.withColumns({"departure_airport_key": dep_key, "arrival_airport_key": arr_key})
    else:
        airports = airports.select("airport_code", "airport_key")
        dep = airports.select(F.col("airport_code").alias("_dep_code"), F.col("airport_key").alias("departure_airport_key"))
        arr = airports.select(F.col("airport_code").alias("_arr_code"), F.col("airport_key").alias("arrival_airport_key"))
        j = (stg.join(dep, stg["departure_airport"] == dep["_dep_code"], "left")
             .join(arr, F.col("arrival_airport") == arr["_arr_code"], "left").drop("_dep_code", "_arr_code"))
    return j.withColumn("flight_duration_minutes", boundary_minutes("departure_time", "arrival_time").cast("long")) \
        .filter(F.col("flight_duration_minutes") > 0)


def build_flight_base(stg: DataFrame, calendar: DataFrame, airports: DataFrame | None = None) -> DataFrame:
    """The flights fact without its rank: keys, duration, one row per (aircraft, departure), latest arrival wins.

    Counts and checks that read no rank use this: one pass over the staged rows.
    """
    w = Window.partitionBy("aircraft_id", "departure_time").orderBy(*dedup_order())
    kept = keyed_flights(stg, airports).withColumn("row_num", F.row_number().over(w).cast("long")).filter(F.col("row_num") == 1)
    cal = calendar.select(F.col("date_day").alias("_day"), F.col("date_key").alias("departure_date_key"))
    return kept.join(cal, F.to_date("departure_time") == F.col("_day"), "left").select(*FCT_COLUMNS[:-1])


def duration_histogram(stg: DataFrame, airports: DataFrame | None = None) -> DataFrame:
    """Staged positive-duration rows per (departure airport, duration), duplicates included.  Histograms of
    disjoint batches add up to the histogram of their union."""
    return keyed_flights(stg, airports).groupBy(*RANK_KEYS).agg(F.count(F.lit(1)).alias("n"))


def add_histograms(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy(*RANK_KEYS).agg(F.sum("n").alias("n"))


def with_duration_rank(base: DataFrame, histogram: DataFrame) -> DataFrame:
    """Add RANK() by duration within the departure airport, over the rows that ``histogram`` counts."""
    r = rank_from_histogram(histogram, RANK_KEYS[:1], RANK_KEYS[1], "duration_rank_from_airport").select(
        F.col(RANK_KEYS[0]).alias("_rk"), F.col(RANK_KEYS[1]).alias("_rd"), "duration_rank_from_airport")
    out = base.join(r, F.col(RANK_KEYS[0]).eqNullSafe(F.col("_rk")) & (F.col(RANK_KEYS[1]) == F.col("_rd")), "left")
    return out.select(*FCT_COLUMNS)


def build_fct_flights(stg: DataFrame, calendar: DataFrame, airports: DataFrame | None = None) -> DataFrame:
    """flights fact: the base, ranked over all staged rows of positive duration (duplicates included)."""
    return with_duration_rank(build_flight_base(stg, calendar, airports), duration_histogram(stg, airports))


FLIGHT_KEYS = ["aircraft_id", "departure_time"]


def merge_flight_base(current: DataFrame, staged: DataFrame, pending: DataFrame, calendar: DataFrame) -> DataFrame:
    """The base after ``pending`` (rows of ``staged`` not merged yet): keys that they touch are decided anew from all
    their staged rows, the others stay.  Equal to a full build over ``staged``, however it was cut into batches."""
    keys = pending.select(*[F.col(k).alias(f"_{k}") for k in FLIGHT_KEYS]).distinct()
    touched = F.col(FLIGHT_KEYS[0]).eqNullSafe(F.col(f"_{FLIGHT_KEYS[0]}")) & F.col(FLIGHT_KEYS[1]).eqNullSafe(F.col(f"_{FLIGHT_KEYS[1]}"))
    again = build_flight_base(staged.join(keys, touched, "left_semi"), calendar)
    return current.join(keys, touched, "left_anti").select(*FCT_COLUMNS[:-1]).unionByName(again)
