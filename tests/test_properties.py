"""Property tests: arithmetic and skew-safe operators equal their brute-force definitions."""

import datetime as dt
import decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from aerolake.functions import boundary_minutes, round_half_up
from aerolake.operators import windows as W

EPOCH = dt.datetime(1970, 1, 1)
BASE = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=15, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
micros = st.integers(min_value=0, max_value=40 * 86400 * 10**6)


def _ts(us):
    return BASE + dt.timedelta(microseconds=us)


@SETTINGS
@given(st.lists(st.tuples(micros, micros), min_size=1, max_size=40))
def test_boundary_minutes(spark, pairs):
    rows = [(_ts(a), _ts(b)) for a, b in pairs]
    got = [r.m for r in spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
           .select(boundary_minutes("a", "b").alias("m")).collect()]
    want = [int((b - EPOCH).total_seconds() // 60) - int((a - EPOCH).total_seconds() // 60) for a, b in rows]
    assert got == want


@SETTINGS
@given(st.lists(st.decimals(min_value=-10**6, max_value=10**6, places=4, allow_nan=False), min_size=1, max_size=40),
       st.integers(min_value=0, max_value=3))
def test_round_half_up(spark, values, scale):
    rows = [(float(v),) for v in values]
    got = [r.r for r in spark.createDataFrame(rows, "x double").select(round_half_up("x", scale).alias("r")).collect()]
    q = decimal.Decimal(1).scaleb(-scale)
    want = [float(decimal.Decimal(repr(x)).quantize(q, rounding=decimal.ROUND_HALF_UP)) for (x,) in rows]
    assert got == want


@SETTINGS
@given(st.lists(micros, min_size=1, max_size=60), st.integers(min_value=1, max_value=6),
       st.integers(min_value=0, max_value=3), st.sampled_from([600, 3600, 7200, 86400]))
def test_slice_windows_equals_range_join(spark, offsets, n, days_back, width):
    anchor = dt.datetime(2024, 2, 10)
    rows = [(i, _ts(us)) for i, us in enumerate(offsets)]
    got = sorted((r.id, r.window_no) for r in W.slice_windows(
        spark.createDataFrame(rows, "id long, ts timestamp_ntz"), "ts", anchor.isoformat(sep=" "), n,
        days_back=days_back, width_s=width).collect())
    want = []
    for i, t in rows:
        for k in range(n):
            end = anchor - dt.timedelta(days=days_back + k)
            if end - dt.timedelta(seconds=width) <= t < end:
                want.append((i, k))
    assert got == sorted(want)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C", None]), st.integers(min_value=0, max_value=6)),
                min_size=1, max_size=50))
def test_rank_desc_equals_rank(spark, rows):
    df = spark.createDataFrame([(p, v, i) for i, (p, v) in enumerate(rows)], "p string, v long, id long")
    got = sorted(map(tuple, W.rank_desc(df, ["p"], "v", "r").select("id", "r").collect()))
    want = sorted(map(tuple, df.withColumn("r", F.rank().over(Window.partitionBy("p").orderBy(F.col("v").desc())))
                      .select("id", "r").collect()))
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(min_value=0, max_value=3 * 86400)),
                min_size=1, max_size=60, unique_by=lambda x: x))
def test_sessions_equal_plain_definition(spark, rows):
    data = [(k, BASE + dt.timedelta(seconds=s)) for k, s in rows]
    df = spark.createDataFrame(data, "icao24 string, event_datetime timestamp_ntz")
    got = sorted((r.icao24, r.session_no, r.positions) for r in W.sessions(df).collect())
    want = []
    for key in {k for k, _ in data}:
        times = sorted(t for k, t in data if k == key)
        sid, count, prev = 0, 0, None
        for t in times:
            new = prev is None or (int((t - EPOCH).total_seconds() // 60) - int((prev - EPOCH).total_seconds() // 60)) > 30
            if new:
                if sid:
                    want.append((key, sid, count))
                sid, count = sid + 1, 0
            count += 1
            prev = t
        want.append((key, sid, count))
    assert got == sorted(want)
