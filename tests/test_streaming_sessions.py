"""Sessions closed by the stream equal the batch query's over the same rows, copies and disorder included."""

import datetime as dt
import os
import random

import pytest

from aerolake.operators import positions as P
from aerolake.operators import windows as W
from aerolake.streaming.sessions import sessions_stream

RAW = ("icao24 string, registration string, aircraft_type string, description string, callsign string, squawk string, latitude double, "
       "longitude double, altitude_ft double, on_ground int, event_timestamp long, event_datetime timestamp_ntz, source string")
START = dt.datetime(2026, 3, 1)
COLUMNS = ["icao24", "session_start", "session_end", "positions", "duration_minutes"]


def row(aircraft, seconds, key="own", latitude=1.0):
    at = START + dt.timedelta(seconds=seconds)
    second = int((at - dt.datetime(1970, 1, 1)).total_seconds()) if key == "own" else key
    return (aircraft, None, None, None, None, None, latitude, 2.0, 100.0, 0, second, at, "t")


def closed_by_stream(spark, folder, deliveries, name, **options):
    for k, rows in enumerate(deliveries):
        path = os.path.join(folder, f"d{k:03d}")
        spark.createDataFrame(rows, RAW).coalesce(1).write.parquet(path)
        for f in os.listdir(path):
            os.utime(os.path.join(path, f), (1_700_000_000 + k, 1_700_000_000 + k))
    stream = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(folder)
    query = sessions_stream(stream, **options).writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return sorted(tuple(r) for r in spark.table(name).select(*COLUMNS).collect())


def closed_by_batch(spark, rows, until):
    """Sessions of the batch query that end more than 31 minutes before ``until``."""
    silver = P.standardise_positions(P.clean_positions(spark.createDataFrame(rows, RAW)))
    found = W.sessions(silver).select(*COLUMNS).collect()
    return sorted(tuple(r) for r in found if r.session_end < START + dt.timedelta(seconds=until - 31 * 60))


def test_random_deliveries(spark, scratch):
    rng = random.Random(11)
    rows = []
    for aircraft in ("a1", "a2", "hot"):
        t = 0.0
        while t < 80_000:
            t += rng.choice([20, 60, 300, 1790, 1830, 1861, 2500, 4000]) * (0.1 if aircraft == "hot" else 1) + rng.random()
            rows.append(row(aircraft if rng.random() < 0.8 else f" {aircraft.upper()} ", t))
    rows += [row(r[0], (r[11] - START).total_seconds() + rng.random() * 0.4, key=r[10]) for r in rng.sample(rows, 60)]  # later copies of a key
    rows += rng.sample(rows, 40)  # exact copies
    rows += [row("a1", 500.0, latitude=200.0), row(None, 600.0)]  # invalid
    rows.sort(key=lambda r: (r[11] - START).total_seconds() + rng.random() * 1500)  # at most 25 minutes late
    size = 120
    deliveries = [rows[i:i + size] for i in range(0, len(rows), size)] + [[row("zz", 200_000)]]
    got = closed_by_stream(spark, scratch, deliveries, "sessions_random", delay="30 minutes")
    want = closed_by_batch(spark, rows, 200_000 - 1800)
    assert len(want) > 20 and got == want


def test_earliest_copy_wins_when_it_comes_last(spark, scratch):
    """30:59.9 and, delivered later, 30:00.0 are copies of one key: the session ends with the earlier one."""
    rows = [[row("a", 10), row("a", 1859.9, key=77)], [row("a", 1800.0, key=77)], [row("z", 50_000)]]
    got = closed_by_stream(spark, scratch, rows, "sessions_copy")
    assert got == closed_by_batch(spark, [r for d in rows for r in d], 50_000 - 3600) and [(r[2].minute, r[2].second, r[3]) for r in got] == [(30, 0, 2)]


def test_timer_closes_silent_aircraft_and_open_sessions_wait(spark, scratch):
    rows = [[row("a", 0), row("a", 60)], [row("b", 20_000)], [row("b", 20_030), row("b", 20_030)]]
    got = closed_by_stream(spark, scratch, rows, "sessions_timer")
    assert [(r[0], r[3], r[4]) for r in got] == [("A", 2, 1)]  # b is still open


def test_positions_without_a_second_share_one_key(spark, scratch):
    rows = [[row("a", 0), row("a", 100, key=None)], [row("a", 200, key=None), row("a", 300)], [row("z", 90_000)], [row("a", 91_000, key=None), row("z", 91_000)], [row("y", 200_000)]]
    got = closed_by_stream(spark, scratch, rows, "sessions_null")
    assert [(r[0], r[3]) for r in got] == [("A", 3), ("Z", 2)]
    assert got == closed_by_batch(spark, [r for d in rows for r in d], 200_000 - 3600)


@pytest.mark.parametrize("minutes", [0, 5])
def test_other_gaps(spark, scratch, minutes):
    rows = [[row("a", s) for s in (0, 59, 60, 61, 400, 401, 3000)], [row("z", 50_000)]]
    got = closed_by_stream(spark, scratch, rows, f"sessions_gap{minutes}", minutes=minutes)
    silver = P.standardise_positions(P.clean_positions(spark.createDataFrame(rows[0], RAW)))
    assert got == sorted(tuple(r) for r in W.sessions(silver, minutes=minutes).select(*COLUMNS).collect())
