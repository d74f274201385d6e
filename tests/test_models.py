"""Literal fixtures for the silver/gold and flights models (FIXTURES.md part C)."""

import datetime as dt

from pyspark.sql import functions as F

from aerolake.operators import flights as FL
from aerolake.operators import positions as P
from aerolake.schemas import POSITIONS_CLEAN, POSITIONS_TEXT


def ts(s):
    return dt.datetime.fromisoformat(s)


def _raw_text(spark, rows):
    return spark.createDataFrame(rows, POSITIONS_TEXT)


def test_clean_positions_from_text(spark):
    rows = [
        # key, reg, type, desc, event_ts, datetime, lat, lon, alt, ground, callsign, squawk, source
        (" ab12cd ", "R1", "A320", "Airbus", "1704067207.9", "2024-01-01T00:00:07.900000+00:00", "10", "20",
         "ground", "0", "ABC1 ", "0632", "adsb.lol"),
        ("AB12CD", "R1", "A320", "Airbus", "1704067207.2", "2024-01-01T00:00:07.200000+00:00", "10", "20",
         "35000", "1", "ABC1", "0632", "adsb.lol"),        # same key after normalisation: earlier kept
        ("ZZ0001", None, None, None, "1704067300", "2024-01-01T00:01:40+00:00", "95", "0", "100", "0",
         None, None, "adsb.lol"),                          # latitude out of range
        (None, None, None, None, "1704067300", "2024-01-01T00:01:40+00:00", "1", "1", "100", "0",
         None, None, "adsb.lol"),                          # no key
        ("ZZ0002", None, None, None, "1704067300", "not a time", "1", "1", "100", "0", None, None, "adsb.lol"),
    ]
    out = P.clean_positions(_raw_text(spark, rows)).collect()
    assert len(out) == 1
    r = out[0]
    assert r.icao24 == "AB12CD" and r.event_timestamp == 1704067207
    assert r.event_datetime == ts("2024-01-01 00:00:07.200000")
    assert r.altitude_ft == 35000.0 and r.altitude_band == "Cruise" and r.squawk == "0632"
    assert r.event_date == dt.date(2024, 1, 1) and r.event_hour == 0


def test_unparseable_altitude_gives_unknown_band(spark):
    rows = [("AB12CD", None, None, None, "1704067207", "2024-01-01T00:00:07+00:00", "1", "1", "ground", "2",
             None, None, "adsb.lol")]
    r = P.clean_positions(_raw_text(spark, rows)).first()
    assert r.altitude_ft is None and r.altitude_band == "Unknown" and r.on_ground == 2


def _clean(spark, rows):
    return spark.createDataFrame(rows, POSITIONS_CLEAN)


def test_silver_fact_and_dims(spark):
    d = dt.date(2026, 1, 3)
    rows = [
        ("AB12CD", "  ", "A320", "", "  ", "0632", 1.0, 2.0, 500.0, 0, 1767398400, ts("2026-01-03 00:00:00"), d, 0, "Low", "x"),
        ("AB12CD", "R-NEW", "A320", "Airbus", "ABC1", "0632", 1.0, 2.0, 500.0, 3, 1767402000, ts("2026-01-03 01:00:00"), d, 1, "Low", "x"),
    ]
    stg = P.standardise_positions(_clean(spark, rows))
    s = stg.orderBy("event_datetime").collect()
    assert s[0].registration is None and s[0].description is None and s[0].callsign is None
    assert (s[0].on_ground_flag, s[0].on_ground_status) == (False, "AIRBORNE")
    assert (s[1].on_ground_flag, s[1].on_ground_status) == (None, "UNKNOWN")
    dim = P.build_dim_aircraft(stg).collect()
    assert len(dim) == 1 and dim[0].registration == "R-NEW"
    dd = P.build_dim_dates(stg).collect()
    assert [(r.date_key, r.month_name, r.day_name, r.day_of_week) for r in dd] == [(20260103, "Jan", "Sat", 6)]
    fact = P.build_fact(stg).collect()
    assert len({r.position_key for r in fact}) == 2 and fact[0].date_key == 20260103


def test_dim_time(spark):
    t = P.build_dim_time(spark).collect()
    assert len(t) == 24 and t[0].hour_label == "12 AM" and t[23].day_period == "Evening"


def test_dim_date_calendar(spark):
    cal = FL.build_dim_date(spark, "2026-01-03", "2026-01-06").orderBy("date_day").collect()
    assert [r.day_of_week for r in cal] == [6, 0, 1]
    assert [r.is_weekend for r in cal] == [True, True, False]
    assert [r.day_name for r in cal] == ["Saturday", "Sunday", "Monday"] and cal[0].month_name == "January"
    assert len(FL.build_dim_date(spark, "2026-01-01", "2027-01-01").collect()) == 365


def _stg_flights(spark, rows):
    schema = ("aircraft_id string, flight_callsign string, departure_airport string, arrival_airport string, "
              "departure_time timestamp_ntz, arrival_time timestamp_ntz, departure_horiz_distance_m double, "
              "arrival_horiz_distance_m double, processed_at timestamp_ntz, _loaded_at timestamp_ntz")
    return spark.createDataFrame(rows, schema)


def test_fct_flights_rank_before_dedup(spark):
    dep = ts("2026-01-03 10:00:00")
    L = ts("2026-01-04 00:00:00")
    rows = [
        # two arrivals for one (aircraft, departure): the later wins, but both count in the rank
        ("a1", "F1", "AP01", "AP02", dep, ts("2026-01-03 13:00:00"), 1.0, 1.0, L, L),
        ("a1", "F1", "AP01", "AP02", dep, ts("2026-01-03 12:00:00"), 1.0, 1.0, L, L),
        ("a2", "F2", "AP01", None, dep, ts("2026-01-03 12:30:00"), 1.0, 1.0, L, L),
        ("a3", "F3", None, "AP02", dep, ts("2026-01-03 11:00:00"), 1.0, 1.0, L, L),
        ("a4", "F4", "AP01", "AP02", dep, ts("2026-01-03 09:00:00"), 1.0, 1.0, L, L),   # negative: dropped
        ("a5", "F5", "AP09", "AP02", ts("2027-02-01 10:00:00"), ts("2027-02-01 10:00:59"), 1.0, 1.0, L, L),
    ]
    stg = _stg_flights(spark, rows)
    cal = FL.build_dim_date(spark, "2026-01-01", "2027-01-01")
    fct = {r.aircraft_id: r for r in FL.build_fct_flights(stg, cal).collect()}
    assert set(fct) == {"a1", "a2", "a3"}          # a5 has 0 boundary minutes
    assert fct["a1"].arrival_time == ts("2026-01-03 13:00:00") and fct["a1"].row_num == 1
    # ranks within AP01 over a1(180), a1(120), a2(150): 1, 3, 2 -> a2 keeps rank 2 although a1's
    # duplicate is removed afterwards
    assert fct["a1"].duration_rank_from_airport == 1 and fct["a2"].duration_rank_from_airport == 2
    assert fct["a3"].departure_airport_key is None and fct["a3"].duration_rank_from_airport == 1
    assert fct["a2"].arrival_airport_key is None and fct["a1"].departure_date_key is not None
    # the explicit dimension join gives the same keys as the hashed-code shortcut
    airports = FL.build_dim_airports(stg)
    joined = {r.aircraft_id: r for r in FL.build_fct_flights(stg, cal, airports=airports).collect()}
    for k in fct:
        assert (fct[k].departure_airport_key, fct[k].arrival_airport_key) == \
            (joined[k].departure_airport_key, joined[k].arrival_airport_key)


def test_stage_flights_run_stamp(spark):
    raw = spark.createDataFrame([("ab", "CS1 ", "AP01", None, 1767434400, 1767438000, 5.0, 6.0, ts("2026-01-03 12:00:00"))],
                                "icao24 string, callsign string, estdepartureairport string, estarrivalairport string, "
                                "firstseen long, lastseen long, estdepartureairporthorizdistance double, "
                                "estarrivalairporthorizdistance double, processed_at timestamp_ntz")
    r = FL.stage_flights(raw, loaded_at="2026-01-05 00:00:00").first()
    assert r.departure_time == ts("2026-01-03 10:00:00") and r.arrival_time == ts("2026-01-03 11:00:00")
    assert r._loaded_at == ts("2026-01-05 00:00:00")
    assert FL.build_dim_airports(FL.stage_flights(raw)).count() == 1


def test_views_and_sql(spark):
    from aerolake.plans.catalog import Models
    from tests.conftest import SF_SMALL
    m = Models(spark, SF_SMALL)
    m.register_views(("stg_positions", "fact_positions", "dim_dates"))
    assert {"stg_positions", "fact_positions", "dim_dates"} <= {t.name for t in spark.catalog.listTables()}
    n = spark.sql("SELECT COUNT(*) AS n FROM fact_positions f LEFT ANTI JOIN dim_dates d ON f.date_key = d.date_key").first().n
    assert n == 0
