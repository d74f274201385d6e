"""Explicit schemas for every source: nothing is inferred on the production path."""

from __future__ import annotations

from pyspark.sql import types as T

# One snapshot of state vectors: {"time": 1700000000, "states": [[...17 values...], ...]}
RAW_STATES = T.StructType([
    T.StructField("time", T.LongType()),
    T.StructField("states", T.ArrayType(T.ArrayType(T.StringType()))),
])

# Positional fields of one state vector (index -> name, type).
STATE_FIELDS = [
    ("icao24", "string"), ("callsign", "string"), ("origin_country", "string"),
    ("time_position", "bigint"), ("last_contact", "bigint"), ("longitude", "double"),
    ("latitude", "double"), ("baro_altitude", "double"), ("on_ground", "boolean"),
    ("velocity", "double"), ("true_track", "double"), ("vertical_rate", "double"),
    ("sensors", "string"), ("geo_altitude", "double"), ("squawk", "string"),
    ("spi", "boolean"), ("position_source", "bigint"),
]

_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}

STATES = T.StructType(
    [T.StructField(n, _TYPES[t]) for n, t in STATE_FIELDS]
    + [T.StructField("snapshot_time", T.LongType()), T.StructField("processed_at", T.TimestampType())]
)

# One aircraft-day trace document; points are heterogeneous arrays, kept as text.
RAW_TRACE = T.StructType([
    T.StructField("icao", T.StringType()),
    T.StructField("r", T.StringType()),
    T.StructField("t", T.StringType()),
    T.StructField("desc", T.StringType()),
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("trace", T.ArrayType(T.ArrayType(T.StringType()))),
])

POINT_META = "flight string, squawk string"

POSITIONS_RAW = T.StructType([
    T.StructField("icao24", T.StringType()),
    T.StructField("registration", T.StringType()),
    T.StructField("aircraft_type", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("event_timestamp", T.DoubleType()),
    T.StructField("event_datetime", T.TimestampNTZType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("altitude_ft", T.DoubleType()),
    T.StructField("on_ground", T.IntegerType()),
    T.StructField("callsign", T.StringType()),
    T.StructField("squawk", T.StringType()),
    T.StructField("source", T.StringType()),
])

# The CSV/text form of raw positions: timestamps are ISO text, altitude may be "ground".
POSITIONS_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in POSITIONS_RAW.fields])

POSITIONS_CLEAN_COLUMNS = [
    "icao24", "registration", "aircraft_type", "description", "callsign", "squawk", "latitude",
    "longitude", "altitude_ft", "on_ground", "event_timestamp", "event_datetime", "event_date",
    "event_hour", "altitude_band", "source",
]

POSITIONS_CLEAN = T.StructType([
    T.StructField("icao24", T.StringType()),
    T.StructField("registration", T.StringType()),
    T.StructField("aircraft_type", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("callsign", T.StringType()),
    T.StructField("squawk", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("altitude_ft", T.DoubleType()),
    T.StructField("on_ground", T.IntegerType()),
    T.StructField("event_timestamp", T.LongType()),
    T.StructField("event_datetime", T.TimestampNTZType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("event_hour", T.IntegerType()),
    T.StructField("altitude_band", T.StringType()),
    T.StructField("source", T.StringType()),
])

#: Valid rows as a run delivered them, with the folders' columns.
POSITIONS_STORED = T.StructType([*(f for f in POSITIONS_CLEAN.fields if f.name not in ("event_date", "event_hour", "altitude_band")),
                                 T.StructField("run", T.StringType()), T.StructField("event_date", T.DateType())])

FLIGHTS_RAW = T.StructType([
    T.StructField("icao24", T.StringType()),
    T.StructField("callsign", T.StringType()),
    T.StructField("estdepartureairport", T.StringType()),
    T.StructField("estarrivalairport", T.StringType()),
    T.StructField("firstseen", T.LongType()),
    T.StructField("lastseen", T.LongType()),
    T.StructField("estdepartureairporthorizdistance", T.DoubleType()),
    T.StructField("estarrivalairporthorizdistance", T.DoubleType()),
    T.StructField("processed_at", T.TimestampNTZType()),
])

# The driver's events table, read as plain Parquet positions input.
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
