"""Ingest shaping: nested snapshot / trace documents -> flat rows.

Everything is positional array access with ``get`` (NULL when the index is out of range, where
``[i]`` raises under ANSI) and ``try_cast`` (bad text -> NULL), so short vectors, the text
"ground" in an altitude slot or a missing metadata object never fail a job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.functions.text import strip_ws
from aerolake.functions.time import EPOCH
from aerolake.schemas import POINT_META, STATE_FIELDS

TRACE_SOURCE = "adsb.lol"   # fixed source tag of trace-derived positions
MIN_POINT_FIELDS = 4        # offset, lat, lon, altitude


def flatten_states(raw_states: DataFrame, run_ts) -> DataFrame:
    """One row per state vector: explode (NULL/empty snapshots vanish), 17 positional fields,
    trimmed callsign, NULL key dropped, exact duplicates removed, then the run stamp."""
    # explode_outer + a filter on the generated column: plain explode makes Catalyst infer
    # "states IS NOT NULL AND size(states) > 0" and push it below the source projection.
    exploded = raw_states.select(F.col("time").cast("long").alias("snapshot_time"),
                                 F.explode_outer("states").alias("state")).filter(F.col("state").isNotNull())
    cols = []
    for i, (name, typ) in enumerate(STATE_FIELDS):
        v = F.get(F.col("state"), i)
        if name == "callsign":
            v = F.trim(v)
        elif typ != "string":
            v = v.try_cast(typ)
        cols.append(v.alias(name))
    flat = exploded.select(*cols, "snapshot_time").filter(F.col("icao24").isNotNull())
    # Exact-row dedup before the stamp: a hash aggregate, copies collapse map-side.
    out = flat.dropDuplicates()
    return out.withColumn("processed_at", F.lit(run_ts).cast("timestamp"))


def flatten_traces(raw_traces: DataFrame, source: str = TRACE_SOURCE) -> DataFrame:
    """Trace documents (header + points) -> positions_raw rows.

    Header guard: no rows without an icao (NULL or empty) or a base timestamp.  Point guard:
    points with fewer than 4 elements, or NULL offset/lat/lon, are skipped.  Event time is
    base + offset seconds; metadata object at index 8 gives flight (whitespace-stripped) and
    squawk; index 6 is the flag kept as ``on_ground``.
    """
    # The header guard is part of the explode input rather than a Filter: a Filter would be
    # pushed below the JSON parse of the documents and make the parser run twice.
    header_ok = F.col("icao").isNotNull() & (F.col("icao") != "") & F.col("timestamp").isNotNull()
    pts = raw_traces.select("icao", "r", "t", "desc", F.col("timestamp").cast("double").alias("base"),
                            F.explode_outer(F.when(header_ok, F.col("trace"))).alias("p"))
    offset = F.get("p", 0).try_cast("double")
    lat = F.get("p", 1).try_cast("double")
    lon = F.get("p", 2).try_cast("double")
    pts = pts.filter(F.col("p").isNotNull() & (F.size("p") >= MIN_POINT_FIELDS) & offset.isNotNull() & lat.isNotNull() & lon.isNotNull())
    meta = F.from_json(F.get("p", 8), POINT_META)
    ev_ts = F.col("base") + offset
    flight = meta.getField("flight")
    return pts.select(
        F.col("icao").alias("icao24"),
        F.col("r").alias("registration"),
        F.col("t").alias("aircraft_type"),
        F.col("desc").alias("description"),
        ev_ts.alias("event_timestamp"),
        F.timestamp_add("MICROSECOND", F.round(ev_ts * 1_000_000).cast("long"), F.expr(EPOCH)).alias("event_datetime"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        F.get("p", 3).try_cast("double").alias("altitude_ft"),
        F.get("p", 6).try_cast("double").try_cast("int").alias("on_ground"),
        F.when(flight.isNotNull() & (flight != ""), strip_ws(flight)).otherwise(flight).alias("callsign"),
        meta.getField("squawk").alias("squawk"),
        F.lit(source).alias("source"),
    )


def parse_trace_documents(docs: DataFrame, text_col: str = "doc") -> DataFrame:
    """JSON text of trace documents -> RAW_TRACE rows (unparseable text gives a NULL header and
    therefore no positions)."""
    from aerolake.schemas import RAW_TRACE
    parsed = docs.select(F.from_json(F.col(text_col), RAW_TRACE).alias("d"))
    return parsed.select("d.*")
