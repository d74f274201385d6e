"""Mappings from the driver's tables onto the flight datasets (see FIXTURES.md, part B).

Each function is a pure projection/join of the driver's tables, so the derived inputs grow with
the scale factor and the DuckDB oracle can state the same mapping in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.functions.time import epoch_seconds

# Fixed values of the mapping (FIXTURES.md B1/B2).
SOURCE_TAG = "adsb.lol"
COPY_EVERY, COPY_REMAINDER = 10, 3          # rows with event_id % 10 = 3 get a second copy
COPY_SHIFT = "INTERVAL '0.25' SECOND"         # ... whose event_datetime is 250 ms later
NULL_KEY_EVERY = 97                          # icao24 NULL when event_id % 97 = 0
GROUND_CODES = {"view": 0, "click": 0, "purchase": 1, "signup": 2}  # 'error' -> NULL
NO_DEPARTURE_NATION = 0                      # departure code NULL for customers of nation 0
NO_ARRIVAL_NATION = 7                        # arrival code NULL for suppliers of nation 7


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def positions_raw_from_events(events: DataFrame) -> DataFrame:
    """positions_raw: one row per event plus a 250 ms-later copy of every tenth, same second."""
    ev = events.select("event_id", "ts", "user_id", "event_type", "value")
    # One scan: explode a 1- or 2-element array instead of a self-union.
    copies = F.when(F.col("event_id") % COPY_EVERY == COPY_REMAINDER, F.array(F.lit(0), F.lit(1))) \
        .otherwise(F.array(F.lit(0)))
    ev = ev.withColumn("copy_no", F.explode(copies))
    uid, eid = F.col("user_id"), F.col("event_id")
    ground = F.lit(None).cast("int")
    for name, code in reversed(list(GROUND_CODES.items())):
        ground = F.when(F.col("event_type") == name, F.lit(code)).otherwise(ground)
    return ev.select(
        F.when(eid % NULL_KEY_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(" ac"), F.lpad(_s(uid), 4, "0"), F.lit(" "))).alias("icao24"),
        F.when(uid % 10 == 0, F.lit("   ")).otherwise(F.concat(F.lit(" R-"), _s(uid), F.lit(" "))).alias("registration"),
        F.concat(F.lit("T"), _s(uid % 7)).alias("aircraft_type"),
        F.when(uid % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("Type "), _s(uid % 7))).alias("description"),
        epoch_seconds("ts").cast("double").alias("event_timestamp"),
        F.when(F.col("copy_no") == 1, F.col("ts") + F.expr(COPY_SHIFT)).otherwise(F.col("ts")).alias("event_datetime"),
        ((eid * 37) % 19000 / 100 - 95.0).alias("latitude"),
        ((eid * 53) % 37000 / 100 - 185.0).alias("longitude"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
         .otherwise(F.round(F.col("value") * 100)).cast("double").alias("altitude_ft"),
        ground.alias("on_ground"),
        F.when(eid % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("CS"), _s(eid % 40), F.lit("  "))).alias("callsign"),
        F.lpad(_s(eid % 7777), 4, "0").alias("squawk"),
        F.lit(SOURCE_TAG).alias("source"),
    )


def _airport_code(nation) -> F.Column:
    return F.concat(F.lit("AP"), F.lpad(_s(nation), 2, "0"))


def flights_raw_from_orders(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                            supplier: DataFrame) -> DataFrame:
    """flights_raw: one flight per line item, airports from customer and supplier nations."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    c = customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    s = supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    # Inner joins on the TPC-H keys; Catalyst/AQE choose broadcast for the small sides by
    # their measured size and shuffle-join the large ones.
    j = li.join(o, "l_orderkey").join(c, "o_custkey").join(s, "l_suppkey")
    return j.select(
        F.concat(F.lit("s"), _s("l_suppkey")).alias("icao24"),
        F.concat(F.lit("FL"), _s("l_orderkey")).alias("callsign"),
        F.when(F.col("c_nationkey") == NO_DEPARTURE_NATION, F.lit(None).cast("string"))
         .otherwise(_airport_code(F.col("c_nationkey"))).alias("estdepartureairport"),
        F.when(F.col("s_nationkey") == NO_ARRIVAL_NATION, F.lit(None).cast("string"))
         .otherwise(_airport_code(F.col("s_nationkey"))).alias("estarrivalairport"),
        epoch_seconds("o_orderdate").alias("firstseen"),
        epoch_seconds("l_shipdate").alias("lastseen"),
        (F.col("l_partkey") % 500 - 1).cast("double").alias("estdepartureairporthorizdistance"),
        (F.col("l_partkey") % 300).cast("double").alias("estarrivalairporthorizdistance"),
        F.col("l_shipdate").alias("processed_at"),
    )


# ---- nested documents derived from events (for the shaping operators) ------------------------
# Fixed values of the derivation (also stated in the oracle SQL).
STATES_NULL_EVERY, STATES_EMPTY_EVERY, STATES_SHORT_EVERY = 71, 73, 50
TRACE_NULL_ICAO_EVERY, TRACE_BLANK_ICAO_EVERY, TRACE_NO_BASE_EVERY = 89, 83, 101


def states_from_events(events: DataFrame) -> DataFrame:
    """raw_states: one snapshot per event (time = epoch s), holding a 17-field vector; some
    snapshots are NULL or empty, every 50th holds a 3-field vector, every tenth repeats its
    vector (exact duplicate).  Values are text, as a JSON reader with this schema yields."""
    eid, uid = F.col("event_id"), F.col("user_id")
    secs = epoch_seconds("ts")
    alt = F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(F.round(F.col("value") * 100))
    lon = (eid * 53) % 37000 / 100 - 185.0
    lat = (eid * 37) % 19000 / 100 - 95.0
    vec = F.array(
        F.when(eid % NULL_KEY_EVERY == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("ab"), F.lpad(_s(uid), 4, "0"))),
        F.concat(F.lit("CS"), _s(eid % 40), F.lit("  ")),
        F.concat(F.lit("Country"), _s(uid % 5)),
        _s(secs), _s(secs + 1), _s(lon), _s(lat), _s(alt),
        F.when(F.col("event_type") == "purchase", F.lit("true")).otherwise(F.lit("false")),
        _s(F.col("value")), _s(eid % 360), F.lit(None).cast("string"), F.lit(None).cast("string"),
        _s(alt + 50.0), F.lpad(_s(eid % 7777), 4, "0"), F.lit("false"), F.lit("0"),
    )
    states = (F.when(eid % STATES_NULL_EVERY == 0, F.lit(None).cast("array<array<string>>"))
              .when(eid % STATES_EMPTY_EVERY == 0, F.array().cast("array<array<string>>"))
              .when(eid % STATES_SHORT_EVERY == 0, F.array(F.slice(vec, 1, 3)))
              .when(eid % COPY_EVERY == COPY_REMAINDER, F.array(vec, vec))
              .otherwise(F.array(vec)))
    return events.select(secs.alias("time"), states.alias("states"))


def trace_docs_from_events(events: DataFrame) -> DataFrame:
    """JSON trace documents, one per event: header (icao, r, t, desc, base = midnight epoch s)
    and two points, the event itself (full 9-element point with metadata, or every 6th a bare
    4-element point) and an invalid one (empty, NULL latitude, or only 3 elements)."""
    eid, uid = F.col("event_id"), F.col("user_id")
    day = F.to_date("ts").cast("timestamp_ntz")
    base = epoch_seconds(day).cast("double")
    # whole milliseconds of the day: integer microseconds, floor-divided
    offset = F.floor(F.timestamp_diff("MICROSECOND", day, F.col("ts")) / 1000) / 1000.0
    lat = (eid * 37) % 19000 / 100 - 95.0
    lon = (eid * 53) % 37000 / 100 - 185.0
    alt = F.when(F.col("event_type") == "signup", F.lit("ground")).otherwise(_s(F.round(F.col("value") * 100)))
    meta = F.when(eid % 3 != 0, F.to_json(F.struct(
        F.concat(F.lit("CS"), _s(eid % 40), F.lit("  ")).alias("flight"),
        F.lpad(_s(eid % 7777), 4, "0").alias("squawk"))))
    full = F.array(_s(offset), _s(lat), _s(lon), alt, F.lit("0"), F.lit("0"), _s(eid % 4),
                   F.lit(None).cast("string"), meta)
    bare = F.array(_s(offset), _s(lat), _s(lon), alt)
    point_a = F.when(eid % 6 == 0, bare).otherwise(full)
    point_b = (F.when(eid % 5 == 0, F.array().cast("array<string>"))
               .when(eid % 5 == 1, F.array(_s(offset + 1), F.lit(None).cast("string"), _s(lon), alt))
               .otherwise(F.array(_s(offset + 2), _s(lat), _s(lon))))
    icao = (F.when(eid % TRACE_NULL_ICAO_EVERY == 0, F.lit(None).cast("string"))
            .when(eid % TRACE_BLANK_ICAO_EVERY == 0, F.lit(""))
            .otherwise(F.concat(F.lit("ac"), F.lpad(_s(uid), 4, "0"))))
    doc = F.struct(
        icao.alias("icao"),
        F.concat(F.lit("R-"), _s(uid)).alias("r"),
        F.concat(F.lit("T"), _s(uid % 7)).alias("t"),
        F.concat(F.lit("Type "), _s(uid % 7)).alias("desc"),
        F.when(eid % TRACE_NO_BASE_EVERY == 0, F.lit(None).cast("double")).otherwise(base).alias("timestamp"),
        F.array(point_a, point_b).alias("trace"),
    )
    return events.select(F.to_json(doc).alias("doc"))
