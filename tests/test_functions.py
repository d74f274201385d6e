import datetime as dt

from pyspark.sql import functions as F

from aerolake.functions import (altitude_band, boundary_minutes, date_key, day_of_week_sun0, day_period,
                                epoch_seconds, from_epoch_seconds, ground_flag, ground_status, hour_label,
                                position_key, round_half_up, surrogate_key)


def ntz(s):
    return dt.datetime.fromisoformat(s)


def test_boundary_minutes_counts_crossed_boundaries(spark):
    df = spark.createDataFrame([(ntz("2026-01-01 00:00:59"), ntz("2026-01-01 00:31:00"))], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(boundary_minutes("a", "b").alias("m"), F.timestamp_diff("MINUTE", "a", "b").alias("elapsed")).first()
    assert (r.m, r.elapsed) == (31, 30)


def test_boundary_minutes_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([(ntz("2024-03-09 23:31:00"), ntz("2024-03-10 10:00:59"))],
                                   "a timestamp_ntz, b timestamp_ntz")
        r = df.select(boundary_minutes("a", "b").alias("m"), epoch_seconds("a").alias("e")).first()
        assert r.m == 629
        assert r.e == int(dt.datetime(2024, 3, 9, 23, 31, tzinfo=dt.timezone.utc).timestamp())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_epoch_round_trip(spark):
    df = spark.createDataFrame([(1704067207,)], "s long")
    r = df.select(from_epoch_seconds("s").alias("t")).first()
    assert r.t == ntz("2024-01-01 00:00:07")


def test_date_key_and_calendar_parts(spark):
    days = [dt.date(2026, 1, 3), dt.date(2026, 1, 4), dt.date(2026, 1, 5)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select(date_key("d").alias("k"), day_of_week_sun0("d").alias("w")).collect()
    assert [r.k for r in rows] == [20260103, 20260104, 20260105]
    assert [r.w for r in rows] == [6, 0, 1]


def test_round_half_up_on_decimal_value(spark):
    df = spark.createDataFrame([(1.005,), (2.5,), (-2.5,), (12.35,)], "x double")
    assert [r.r for r in df.select(round_half_up("x", 2).alias("r")).collect()][:1] == [1.01]
    assert [r.r for r in df.select(round_half_up("x", 0).alias("r")).collect()][1:3] == [3.0, -3.0]
    assert df.select(round_half_up("x", 1).alias("r")).collect()[3].r == 12.4


def test_codes(spark):
    df = spark.createDataFrame([(None,), (0,), (1,), (2,), (3,)], "g int")
    rows = df.select(ground_flag("g").alias("f"), ground_status("g").alias("s")).collect()
    assert [r.f for r in rows] == [None, False, True, None, None]
    assert [r.s for r in rows] == ["UNKNOWN", "AIRBORNE", "ON GROUND", "UNKNOWN", "UNKNOWN"]
    alt = spark.createDataFrame([(None,), (2999.0,), (3000.0,), (9999.0,), (10000.0,)], "a double")
    assert [r.b for r in alt.select(altitude_band("a").alias("b")).collect()] == ["Unknown", "Low", "Mid", "Mid", "Cruise"]


def test_hour_labels(spark):
    rows = spark.range(24).select(hour_label(F.col("id").cast("int")).alias("l"),
                                  day_period(F.col("id").cast("int")).alias("p")).collect()
    assert [r.l for r in rows][:2] == ["12 AM", "1 AM"]
    assert rows[12].l == "12 PM" and rows[13].l == "1 PM" and rows[23].l == "11 PM"
    assert [rows[i].p for i in (0, 5, 6, 11, 12, 17, 18, 23)] == [
        "Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening"]


def test_keys(spark):
    import hashlib
    df = spark.createDataFrame([("AP01", "AB12CD", 1704067207), (None, None, None)], "c string, i string, t long")
    rows = df.select(surrogate_key("c").alias("k"), position_key("i", "t").alias("p")).collect()
    assert rows[0].k == hashlib.md5(b"AP01").hexdigest()
    assert rows[1].k == hashlib.md5(b"_dbt_utils_surrogate_key_null_").hexdigest()
    assert rows[0].p == hashlib.sha256(b"AB12CD|1704067207").hexdigest()
    assert rows[1].p is None


def test_utc_now_ntz_ignores_session_zone(spark):
    from aerolake.functions.time import utc_now_ntz
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        got = spark.range(1).select(utc_now_ntz().alias("t")).first().t
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs((got - now).total_seconds()) < 120
