"""Track 2: raw positions -> cleaned (bronze) -> silver -> fact and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.functions.codes import (altitude_band, day_period, ground_flag, ground_status, hour_label,
                                      position_key)
from aerolake.functions.text import blank_to_null, upper_trim
from aerolake.functions.time import date_key, day_of_week_sun0
from aerolake.schemas import POSITIONS_CLEAN_COLUMNS


def _as_ntz(df: DataFrame, name: str) -> F.Column:
    """event_datetime as TIMESTAMP_NTZ whatever the input type (ISO text, zoned or NTZ)."""
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, T.StringType):
        # Text with or without fraction/offset; bad text -> NULL (dropped by the key filter).
        return F.try_to_timestamp(col).cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return col.cast("timestamp_ntz")
    return col


def _num(col: str, to: str) -> F.Column:
    return F.col(col).try_cast(to)


def normalise_positions(raw: DataFrame) -> DataFrame:
    """Row-level part of the cleaning (also usable on a stream): typed columns, normalised key,
    key/time/geo validity filter."""
    return raw.select(
        upper_trim("icao24").alias("icao24"),
        F.col("registration").cast("string").alias("registration"),
        F.col("aircraft_type").cast("string").alias("aircraft_type"),
        F.col("description").cast("string").alias("description"),
        F.col("callsign").cast("string").alias("callsign"),
        F.col("squawk").cast("string").alias("squawk"),
        _num("latitude", "double").alias("latitude"),
        _num("longitude", "double").alias("longitude"),
        _num("altitude_ft", "double").alias("altitude_ft"),
        _num("on_ground", "int").alias("on_ground"),
        _num("event_timestamp", "double").try_cast("long").alias("event_timestamp"),
        _as_ntz(raw, "event_datetime").alias("event_datetime"),
        F.col("source").cast("string").alias("source"),
    ).filter(valid_position())


def valid_position() -> F.Column:
    """Key, time and coordinates present and in range."""
    return (F.col("icao24").isNotNull() & F.col("event_datetime").isNotNull()
            & F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180))


def derive_position_columns(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """event_date, event_hour, altitude_band and the fixed bronze column order (plus ``keep``)."""
    out = df.withColumns({
        "event_date": F.to_date("event_datetime"),
        "event_hour": F.hour("event_datetime").cast("int"),
        "altitude_band": altitude_band("altitude_ft"),
    })
    return out.select(*POSITIONS_CLEAN_COLUMNS, *keep)


def clean_positions(raw: DataFrame, within_date: bool = False) -> DataFrame:
    """Type normalisation, key/geo validity filter, dedup on (icao24, event_timestamp), derived
    date/hour/band, fixed column order (the historical processing job).

    Dedup keeps the earliest event_datetime of each key; ties are broken by every remaining column, so
    the result doesn't depend on input order; the key is normalised (upper/trim) before dedup.  ``within_date``
    decides each key within its date, so that dates cleaned together or one by one give the same.
    """
    typed = normalise_positions(raw)
    date = [F.to_date("event_datetime")] if within_date else []
    # Top-1 per key: Catalyst plans a partial WindowGroupLimit before the shuffle, so copies
    # collapse map-side and a heavily duplicated key never travels whole.
    w = Window.partitionBy("icao24", "event_timestamp", *date).orderBy(
        F.col("event_datetime").asc(), F.col("latitude").asc_nulls_last(), F.col("longitude").asc_nulls_last(),
        F.col("altitude_ft").asc_nulls_last(), F.col("callsign").asc_nulls_last(),
        F.col("squawk").asc_nulls_last(), F.col("registration").asc_nulls_last(),
        F.col("aircraft_type").asc_nulls_last(), F.col("description").asc_nulls_last(),
        F.col("on_ground").asc_nulls_last(), F.col("source").asc_nulls_last())
    dedup = typed.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    return derive_position_columns(dedup)


STG_COLUMNS = [
    "icao24", "registration", "aircraft_type", "description", "callsign", "squawk", "latitude",
    "longitude", "altitude_ft", "on_ground", "on_ground_flag", "on_ground_status", "event_timestamp",
    "event_datetime", "event_date", "event_hour", "altitude_band", "source",
]


def standardise_positions(clean: DataFrame) -> DataFrame:
    """Silver model: trimmed keys, blank text -> NULL, ground flag/status, validity filter."""
    return clean.filter(valid_position()).select(
        upper_trim("icao24").alias("icao24"),
        blank_to_null("registration").alias("registration"),
        blank_to_null("aircraft_type").alias("aircraft_type"),
        blank_to_null("description").alias("description"),
        blank_to_null("callsign").alias("callsign"),
        F.col("squawk"),
        F.col("latitude"),
        F.col("longitude"),
        F.col("altitude_ft"),
        F.col("on_ground"),
        ground_flag("on_ground").alias("on_ground_flag"),
        ground_status("on_ground").alias("on_ground_status"),
        F.col("event_timestamp"),
        F.col("event_datetime"),
        F.to_date("event_datetime").alias("event_date"),
        F.col("event_hour"),
        F.col("altitude_band"),
        F.col("source"),
    )


FACT_COLUMNS = [
    "position_key", "aircraft_key", "date_key", "event_timestamp", "event_datetime", "event_date",
    "event_hour", "latitude", "longitude", "altitude_ft", "altitude_band", "on_ground", "on_ground_flag",
    "on_ground_status", "callsign", "squawk", "source",
]


def build_fact(stg: DataFrame) -> DataFrame:
    """fact_aircraft_positions: narrow projection with hashed position key and integer date key."""
    return stg.select(
        position_key("icao24", "event_timestamp").alias("position_key"),
        F.col("icao24").alias("aircraft_key"),
        date_key("event_date").alias("date_key"),
        *[c for c in FACT_COLUMNS[3:]],
    )


STATE_COLUMNS = ["icao24", "registration", "aircraft_type", "description", "event_datetime", "event_timestamp"]


def latest_rows(stg: DataFrame, *also: str) -> DataFrame:
    """The latest row of each aircraft (and each value of ``also``) in STATE_COLUMNS, by a total order: the latest of some rows'
    latest is the latest of all (ROW_NUMBER ... = 1, partial limit map-side)."""
    w = Window.partitionBy("icao24", *also).orderBy(
        F.col("event_datetime").desc(), F.col("event_timestamp").desc(),
        F.col("registration").asc_nulls_last(), F.col("aircraft_type").asc_nulls_last(),
        F.col("description").asc_nulls_last())
    return stg.select(*STATE_COLUMNS, *also).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def aircraft_states(stg: DataFrame) -> DataFrame:
    """Each date's latest row per aircraft; ``build_dim_aircraft`` and ``build_dim_dates`` over all dates' states equal those over all rows."""
    return latest_rows(stg, "event_date")


def build_dim_aircraft(stg: DataFrame) -> DataFrame:
    """Latest descriptive attributes per aircraft."""
    return latest_rows(stg).select(F.col("icao24").alias("aircraft_key"), "icao24", "registration", "aircraft_type", "description")


def build_dim_dates(stg: DataFrame) -> DataFrame:
    """Observed dates: distinct first (partial aggregation), then derive the attributes."""
    d = stg.select("event_date").distinct()
    return d.select(
        date_key("event_date").alias("date_key"),
        F.col("event_date"),
        F.year("event_date").cast("int").alias("year"),
        F.month("event_date").cast("int").alias("month"),
        F.date_format("event_date", "MMM").alias("month_name"),
        F.dayofmonth("event_date").cast("int").alias("day"),
        day_of_week_sun0("event_date").alias("day_of_week"),
        F.date_format("event_date", "EEE").alias("day_name"),
    )


def build_dim_time(spark: SparkSession) -> DataFrame:
    """24 hours with label and day period."""
    h = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    return h.select(
        F.col("hour").alias("time_key"),
        F.col("hour").alias("hour_number"),
        hour_label("hour").alias("hour_label"),
        day_period("hour").alias("day_period"),
    )
