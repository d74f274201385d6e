"""Checks counted on the write: same numbers as a scan, failing rows stored, no scan when quality is asked for."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from aerolake.operators import quality as DQ
from aerolake.plans import jobs
from aerolake.plans.measures import Measures
from aerolake.schemas import FLIGHTS_RAW
from aerolake.sources.sinks import write_parquet, write_partitioned
from tests.test_streaming_sessions import RAW, row

STAMP = dt.datetime(2026, 1, 4)


def flight(aircraft, callsign, seen, distance):
    return (aircraft, callsign, "AP01", "AP02", seen, None if seen is None else seen + 3600, distance, 1.0, STAMP)


def row_level(spark, wh):
    return {(r.test, r.model, r.column_name): r.failing_rows for r in jobs.run_quality(spark, wh).filter(F.col("test").isin(*DQ.ROW_LEVEL)).collect()}


def by_scan(spark, wh):
    """The same checks over the tables themselves."""
    names = {"clean_positions": "positions_clean", "stg_positions": "positions_silver", "stg_flights": "flights_stg"}
    out = {}
    for kind in DQ.ROW_LEVEL:
        for c in DQ.declared_checks(kind):
            if c.model == "fct_flights":
                path = max(glob.glob(f"{wh}/fct_flights/version=*"), default="")
            else:
                path = f"{wh}/{names.get(c.model, c.model)}"
            if os.path.exists(path):
                out[(c.kind, c.model, c.column)] = spark.read.parquet(path).filter(DQ.violates(c)).count()
    return out


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    """Positions of two days, flights of two runs; two flights without an aircraft and one with a negative distance."""
    wh = str(tmp_path_factory.mktemp("measures") / "wh")
    jobs.run_positions(spark, spark.createDataFrame([row("a", 10), row("a", 10), row("b", 90_000)], RAW), wh, "2026-03-02 00:00:00")
    flights = [flight("a1", "F1", 1767434400, 1.0), flight(None, "F2", 1767434400, 1.0), flight("a3", "F3", 1767434400, -5.0)]
    jobs.run_flights(spark, spark.createDataFrame(flights, FLIGHTS_RAW), wh, "2026-01-05 00:00:00")
    jobs.run_flights(spark, spark.createDataFrame([flight(None, "F4", 1767520800, 2.0)], FLIGHTS_RAW), wh, "2026-01-06 00:00:00")
    return wh


def test_summary_equals_a_scan(spark, warehouse):
    got = row_level(spark, warehouse)
    assert got == by_scan(spark, warehouse)
    assert got[("not_null", "stg_flights", "aircraft_id")] == 2 and got[("accepted_range", "stg_flights", "departure_horiz_distance_m")] == 1


def test_failing_rows_are_stored(spark, warehouse):
    stored = spark.read.parquet(f"{warehouse}/quarantine/checks/stg_flights").collect()
    found = sorted((r.test, r.column_name, json.loads(r.row)["flight_callsign"]) for r in stored)
    assert found == [("accepted_range", "departure_horiz_distance_m", "F3"), ("not_null", "aircraft_id", "F2"), ("not_null", "aircraft_id", "F4")]


def test_row_level_checks_scan_nothing(spark, warehouse):
    plan = jobs.run_quality(spark, warehouse).filter(F.col("test").isin(*DQ.ROW_LEVEL))._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in plan.lower()


def test_a_run_staged_again_replaces_its_measure(spark, scratch):
    wh = os.path.join(scratch, "again")
    for distance, want in ((-1.0, 1), (4.0, 0), (-2.0, 1)):
        jobs.stage_flights(spark, spark.createDataFrame([flight("a", "F", 1767434400, distance)], FLIGHTS_RAW), wh, "2026-01-05 00:00:00")
        got = row_level(spark, wh)
        assert got == by_scan(spark, wh) and got[("accepted_range", "stg_flights", "departure_horiz_distance_m")] == want
        stored = glob.glob(f"{wh}/quarantine/checks/stg_flights/scope=*/*.parquet")
        assert (spark.read.parquet(*stored).count() if stored else 0) == want


def test_dates_are_measured_one_by_one(spark, scratch):
    """Failing rows of one date go with that date; others keep theirs."""
    m, path = Measures(spark, scratch), os.path.join(scratch, "positions_silver")
    schema = "icao24 string, event_datetime timestamp_ntz, latitude double, longitude double, on_ground_status string, event_date date"

    def put(rows):
        df = spark.createDataFrame(rows, schema)
        days = sorted({str(r[-1]) for r in rows})
        return m.write("stg_positions", df, lambda x: write_partitioned(x, path, ["event_date"]),
                       lambda: spark.read.parquet(path).filter(F.col("event_date").isin(*days)), days, F.col("event_date").cast("string"))

    one, two = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    good = lambda d: ("a", dt.datetime(2026, 1, 1), 1.0, 2.0, "AIRBORNE", d)
    bad = lambda d: (None, dt.datetime(2026, 1, 1), None, 2.0, "FLYING", d)
    assert put([good(one), bad(one), bad(two), bad(two)]) == 4
    read = m.read("stg_positions")
    assert read[str(one)]["not_null icao24"] == 1 and read[str(two)]["accepted_values on_ground_status"] == 2 and read[str(two)]["not_null longitude"] == 0
    assert put([good(two)]) == 1
    read = m.read("stg_positions")
    assert read[str(one)]["not_null latitude"] == 1 and set(read[str(two)].values()) == {0}
    assert {str(r.scope) for r in spark.read.parquet(m.quarantine("stg_positions")).collect()} == {str(one)}


def test_a_write_that_dies_leaves_the_scope_unmeasured(spark, scratch):
    m, path, c = Measures(spark, scratch), os.path.join(scratch, "dim_airports"), DQ.row_level_checks("dim_airports")
    df = spark.createDataFrame([("k",), (None,)], "airport_key string")
    m.write("dim_airports", df, lambda x: write_parquet(x, path), lambda: spark.read.parquet(path))
    assert m.summary(c, "dim_airports", ["all"]) == [("not_null", "dim_airports", "airport_key", 1)]

    def dies(x):
        write_parquet(x.filter("airport_key IS NOT NULL"), path)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        m.write("dim_airports", df, dies, lambda: spark.read.parquet(path))
    assert m.summary(c, "dim_airports", ["all"]) is None
    q = {(r.test, r.model): r.failing_rows for r in jobs.run_quality(spark, scratch).collect()}
    assert q[("not_null", "dim_airports")] == 0  # scanned


def test_empty_frames_measure_nothing_failing(spark, scratch):
    m, path = Measures(spark, scratch), os.path.join(scratch, "dim_airports")
    assert m.write("dim_airports", spark.createDataFrame([], "airport_key string"), lambda x: write_parquet(x, path), lambda: spark.read.parquet(path)) == 0
    assert m.summary(DQ.row_level_checks("dim_airports"), "dim_airports", ["all"]) == [("not_null", "dim_airports", "airport_key", 0)]
