"""Skew-safe window operators agree with the plain window definitions."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from aerolake.operators import windows as W


def ts(s):
    return dt.datetime.fromisoformat(s)


def _random_positions(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        key = "HOT" if rnd.random() < 0.4 else f"K{rnd.randrange(30)}"   # one key holds ~40%
        rows.append((key, base + dt.timedelta(seconds=rnd.randrange(0, 5 * 86400)), i))
    return spark.createDataFrame(rows, "k string, t timestamp_ntz, id long")


def test_lag_across_buckets_equals_plain_lag(spark):
    df = _random_positions(spark)
    got = W.lag_across_buckets(df, "k", "t", "prev", [F.col("id")])
    want = df.withColumn("prev", F.lag("t").over(Window.partitionBy("k").orderBy("t", "id")))
    assert sorted(map(tuple, got.select("id", "prev").collect())) == sorted(map(tuple, want.select("id", "prev").collect()))


def test_running_count_across_buckets(spark):
    df = _random_positions(spark).withColumn("flag", (F.col("id") % 3 == 0).cast("int"))
    got = W.running_count_across_buckets(df, "k", "t", "flag", "run", [F.col("id")])
    want = df.withColumn("run", F.sum("flag").over(
        Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted(map(tuple, got.select("id", "run").collect())) == sorted(map(tuple, want.select("id", "run").collect()))


def test_rank_desc_matches_rank_with_null_partition(spark):
    rows = [("A", 5), ("A", 5), ("A", 3), ("A", 9), (None, 4), (None, 4), (None, 1), ("B", 2)]
    df = spark.createDataFrame(rows, "p string, v long").withColumn("id", F.monotonically_increasing_id())
    got = W.rank_desc(df, ["p"], "v", "r")
    want = df.withColumn("r", F.rank().over(Window.partitionBy("p").orderBy(F.col("v").desc())))
    assert sorted(map(tuple, got.select("id", "r").collect())) == sorted(map(tuple, want.select("id", "r").collect()))


def test_sessions_split_only_above_threshold(spark):
    # gaps of exactly 30 boundary minutes stay in the session; 31 start a new one
    t = ["2024-01-01 00:00:00", "2024-01-01 00:30:00", "2024-01-01 01:01:00", "2024-01-01 01:02:00"]
    df = spark.createDataFrame([("X", ts(x)) for x in t], "icao24 string, event_datetime timestamp_ntz")
    s = W.sessions(df).orderBy("session_no").collect()
    assert [(r.session_no, r.positions) for r in s] == [(1, 2), (2, 2)]


def test_minute_edge_gap(spark):
    t = ["2024-01-01 00:00:59", "2024-01-01 00:31:00"]
    df = spark.createDataFrame([("X", ts(x)) for x in t], "icao24 string, event_datetime timestamp_ntz")
    g = W.detect_gaps(df).collect()
    assert len(g) == 1 and g[0].minutes_since_last == 31


def test_day_over_day_null_percent(spark):
    rows = [(dt.date(2024, 1, 1), 0), (dt.date(2024, 1, 2), 5), (dt.date(2024, 1, 3), 10)]
    df = spark.createDataFrame(rows, "d date, n long")
    out = W.day_over_day(df, "d", "n").orderBy("d").collect()
    assert [r.prev_day_rows for r in out] == [None, 0, 5]
    assert [r.pct_change for r in out] == [None, None, 100.0]


def test_running_share_ties_share_a_value(spark):
    df = spark.createDataFrame([("a", 4), ("b", 4), ("c", 2)], "band string, n long")
    out = {r.band: r.cumulative_pct for r in W.running_share(df, "n").collect()}
    assert out["a"] == out["b"] == 80.0 and out["c"] == 100.0


def test_rank_top_k(spark):
    df = spark.createDataFrame([("a", 3), ("b", 5), ("c", 5), ("d", 1)], "k string, n long")
    out = W.rank_top_k(df, "n", 3, ["k"]).collect()
    assert [(r.k, r.rank) for r in out] == [("b", 1), ("c", 1), ("a", 3)]


def test_slice_windows_bounds(spark):
    anchor = "2024-01-31 00:00:00"
    t = ["2024-01-30 00:00:00",  # end of window 0 -> excluded
         "2024-01-29 23:59:59",  # inside window 0
         "2024-01-29 22:00:00",  # begin of window 0 -> included
         "2024-01-29 21:59:59",  # just before -> excluded
         "2024-01-25 23:00:00",  # window 4
         "2024-01-24 23:00:00"]  # would be window 5 -> excluded
    df = spark.createDataFrame([(i, ts(x)) for i, x in enumerate(t)], "id long, ts timestamp_ntz")
    out = W.slice_windows(df, "ts", anchor, 5).orderBy("id").collect()
    assert [(r.id, r.window_no) for r in out] == [(1, 0), (2, 0), (4, 4)]
    assert out[0].window_end == ts("2024-01-30 00:00:00") and out[0].window_begin == ts("2024-01-29 22:00:00")


def test_pick_days_back_is_reproducible():
    assert W.pick_days_back(7) == W.pick_days_back(7)
    assert all(1 <= W.pick_days_back(s) <= 60 for s in range(50))


def test_bitmaps_of_hours_add_up(spark):
    """Daily numbers from stored hourly bitmaps equal count_distinct; a late hour replaces its own bitmap only."""
    from pyspark.sql import functions as F

    from aerolake.operators import uniques as U
    rows = [(dt.date(2026, 1, 1 + i % 3), i % 5, f"A{i * i % 70000}") for i in range(40_000)]
    df = spark.createDataFrame(rows, "event_date date, event_hour int, icao24 string")
    numbers = U.dense_numbers(df, "icao24").cache()
    n = df.select("icao24").distinct().count()
    assert sorted(r.number for r in numbers.collect()) == list(range(n))
    hours = U.hourly_bitmaps(df.filter("NOT (event_hour = 2 AND event_date = DATE '2026-01-02')"), numbers)
    late = U.hourly_bitmaps(df.filter("event_hour = 2 AND event_date = DATE '2026-01-02'"), numbers)
    days = U.unique_counts(U.merged(hours.unionByName(late), "event_date"), "event_date")
    want = df.groupBy("event_date").agg(F.count_distinct("icao24").alias("unique_aircraft"))
    assert sorted(map(tuple, days.collect())) == sorted(map(tuple, want.collect()))
    assert U.unique_aircraft(df.limit(0), U.dense_numbers(df.limit(0), "icao24")).count() == 0
