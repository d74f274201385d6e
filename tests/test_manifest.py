"""The flights fact as a manifest table: copy-on-write by departure day."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from aerolake.operators import incremental as INC
from aerolake.plans import jobs
from aerolake.schemas import FLIGHTS_RAW
from aerolake.sources.manifest import ManifestTable

DAY = dt.datetime(2026, 1, 3, tzinfo=dt.timezone.utc)


def _flights(spark, *rows):
    """(aircraft, departure airport, day, start hour, minutes)"""
    made = []
    for a, dep, day, hour, minutes in rows:
        start = int((DAY + dt.timedelta(days=day, hours=hour)).timestamp())
        made.append((a, f"F{a}", dep, "EB", start, start + 60 * minutes, 1.0, 1.0, dt.datetime(2026, 1, 4)))
    return spark.createDataFrame(made, FLIGHTS_RAW)


def _rows(df):
    columns = ["aircraft_id", "departure_time", "arrival_time", "departure_airport_key", "departure_date_key", "flight_duration_minutes", "duration_rank_from_airport", "_loaded_at", "row_num"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


BATCHES = [
    [("a1", "EA", 0, 10, 120), ("a2", "EA", 1, 10, 60), ("a3", None, 2, 10, 30), ("zz", "EA", 1, 1, 0)],
    [("a2", "EA", 1, 10, 90), ("a2", "EA", 1, 10, 90), ("a4", "EX", 1, 11, 20)],
    [("a5", "EA", 5, 9, 600)],
    [("a1", "EX", 0, 10, 45), ("a5", "EA", 5, 9, 300)],
]


def test_a_days_delivery_writes_that_day_and_equals_a_full_build(spark, scratch):
    wh = os.path.join(scratch, "byday")
    table = jobs.flights_by_day(spark, wh)
    touched = [3, 1, 1, 2]
    for k, batch in enumerate(BATCHES):
        before = table.manifest()
        jobs.stage_flights(spark, _flights(spark, *batch), wh, f"2026-01-1{k} 00:00:00")
        out = jobs.build_flights_by_day(spark, wh, keep=10)
        assert out == {"version": k + 1, "days": touched[k]}
        if before:
            days = {str((DAY + dt.timedelta(days=r[2])).date()) for r in batch}
            now = table.manifest()["files"]
            assert {d for d in now if now[d] != before["files"].get(d)} == days
        full = jobs.build_flights(spark, wh, incremental=False)
        assert _rows(jobs.read_flights_by_day(spark, wh)) == _rows(spark.read.parquet(full["fct_path"]))
    assert jobs.build_flights_by_day(spark, wh) == {"version": 4, "days": 0}
    # every version still reads as it was; a staged run that changes makes all days anew
    first = _rows(jobs.read_flights_by_day(spark, wh, 1))
    assert {r[0] for r in first} == {"a1", "a2", "a3"} and [r[6] for r in first] == [1, 2, 1]
    jobs.stage_flights(spark, _flights(spark, ("a9", "EA", 0, 1, 5)), wh, "2026-01-10 00:00:00")
    assert jobs.build_flights_by_day(spark, wh, keep=2)["version"] == 5
    full = jobs.build_flights(spark, wh, incremental=False)
    assert _rows(jobs.read_flights_by_day(spark, wh)) == _rows(spark.read.parquet(full["fct_path"]))
    assert table.versions() == [4, 5] and len(INC.children(spark, f"{table.path}/durations")) == 2


def test_filters_on_the_day_prune_files(spark, scratch):
    wh = os.path.join(scratch, "prune")
    jobs.stage_flights(spark, _flights(spark, *BATCHES[0]), wh, "2026-01-10 00:00:00")
    jobs.build_flights_by_day(spark, wh)
    one = jobs.flights_by_day(spark, wh).read().filter(F.col("departure_day") == F.lit("2026-01-04").cast("date"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(departure_day" in plan and one.count() == 1


def test_vacuum_and_commits_that_died(spark, scratch, monkeypatch):
    wh = os.path.join(scratch, "vac")
    table = jobs.flights_by_day(spark, wh)
    jobs.stage_flights(spark, _flights(spark, *BATCHES[0]), wh, "2026-01-10 00:00:00")
    jobs.build_flights_by_day(spark, wh)
    want = _rows(jobs.read_flights_by_day(spark, wh))
    jobs.stage_flights(spark, _flights(spark, *BATCHES[1]), wh, "2026-01-11 00:00:00")
    with monkeypatch.context() as m:
        m.setattr(ManifestTable, "_put", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.build_flights_by_day(spark, wh)
    assert table.versions() == [1] and _rows(jobs.read_flights_by_day(spark, wh)) == want
    assert len(INC.children(spark, f"{table.path}/data")) == 2
    assert len(table.vacuum()) == 1 and len(INC.children(spark, f"{table.path}/data")) == 1
    assert jobs.build_flights_by_day(spark, wh, keep=1)["version"] == 2
    # of the first commit's folder only the days that version 2 still uses are left
    left = {f for name in INC.children(spark, f"{table.path}/data") for f in INC.children(spark, f"{table.path}/data/{name}") if "=" in f}
    assert len(left) == 3 and table.versions() == [2] and len(_rows(jobs.read_flights_by_day(spark, wh))) == 4


def test_rows_outside_the_replaced_partitions_and_a_second_writer_are_refused(spark, scratch):
    schema = spark.createDataFrame([], "k string, n int, day string").schema
    table = ManifestTable(spark, os.path.join(scratch, "plain"), schema, "day")
    assert table.read().count() == 0 and table.manifest() is None and table.vacuum() == []
    make = lambda *rows: spark.createDataFrame(rows, schema)
    table.commit(make(("a", 1, "x"), ("b", 2, "y"), ("c", 3, None)), None, None)
    base = table.manifest()
    with pytest.raises(ValueError):
        table.commit(make(("z", 9, "y")), ["x"], base)
    assert table.commit(make(("a", 7, "x")), ["x"], base) == 2
    with pytest.raises(OSError):
        table.commit(make(("a", 8, "x")), ["x"], base)
    assert sorted(map(tuple, table.read().collect()), key=str) == [("a", 7, "x"), ("b", 2, "y"), ("c", 3, None)]
    assert sorted(map(tuple, table.read(1).collect()), key=str) == [("a", 1, "x"), ("b", 2, "y"), ("c", 3, None)]
    assert table.commit(make(), ["x", "y"], table.manifest()) == 3
    assert [tuple(r) for r in table.read().collect()] == [("c", 3, None)]
