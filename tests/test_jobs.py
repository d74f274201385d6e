"""End-to-end batch jobs over the smallest driver tables, written to a scratch warehouse."""

import os

from aerolake.plans import jobs
from aerolake.plans.catalog import Models
from tests.conftest import SF_SMALL


def test_positions_and_flights_jobs(spark, scratch):
    m = Models(spark, SF_SMALL)
    wh = os.path.join(scratch, "wh")
    counts = jobs.run_positions(spark, m.positions_raw, wh)
    assert counts["raw_rows"] == m.positions_raw.count()
    assert counts["clean_rows"] == m.clean_positions.count() == counts["silver_rows"]
    assert spark.read.parquet(f"{wh}/fact_positions").count() == counts["silver_rows"]
    daily = spark.read.parquet(f"{wh}/agg_daily_traffic")
    assert sorted(map(tuple, daily.collect())) == sorted(map(tuple, m.agg_daily_traffic.select(*daily.columns).collect()))
    # re-running the job is idempotent (dynamic partition overwrite)
    jobs.run_positions(spark, m.positions_raw, wh)
    assert spark.read.parquet(f"{wh}/positions_clean").count() == counts["clean_rows"]

    first = jobs.run_flights(spark, m.flights_raw, wh, loaded_at="2026-01-01 00:00:00",
                             calendar=("1996-01-01", "2001-01-01"))
    fct1 = spark.read.parquet(first["fct_path"])
    assert fct1.count() == m.fct_flights.count()
    second = jobs.run_flights(spark, m.flights_raw, wh, loaded_at="2026-01-02 00:00:00",
                              calendar=("1996-01-01", "2001-01-01"))
    fct2 = spark.read.parquet(second["fct_path"])
    assert fct2.count() == fct1.count()   # same keys re-delivered: replaced, not duplicated
    q = {(r.test, r.model, r.column_name): r.failing_rows for r in jobs.run_quality(spark, wh).collect()}
    assert q[("unique", "fact_positions", "position_key")] == 0
    assert q[("relationships", "fact_positions", "date_key")] == 0


def test_flights_incremental_late_arrival(spark, scratch):
    import datetime as dt
    from pyspark.sql import functions as F
    from aerolake.schemas import FLIGHTS_RAW
    wh = os.path.join(scratch, "wh2")
    L = dt.datetime(2026, 1, 4)
    t = lambda s: int(dt.datetime.fromisoformat(s).replace(tzinfo=dt.timezone.utc).timestamp())
    first = [("a1", "F1", "AP01", "AP02", t("2026-01-03 10:00:00"), t("2026-01-03 12:00:00"), 1.0, 1.0, L),
             ("a2", "F2", "AP01", "AP02", t("2026-01-03 10:00:00"), t("2026-01-03 11:00:00"), 1.0, 1.0, L)]
    jobs.run_flights(spark, spark.createDataFrame(first, FLIGHTS_RAW), wh, "2026-01-05 00:00:00")
    # a later delivery changes a2's arrival (now the longest flight) and adds a3 elsewhere
    second = [("a2", "F2", "AP01", "AP02", t("2026-01-03 10:00:00"), t("2026-01-03 15:00:00"), 1.0, 1.0, L),
              ("a3", "F3", "AP03", "AP02", t("2026-01-03 10:00:00"), t("2026-01-03 10:30:00"), 1.0, 1.0, L)]
    out = jobs.run_flights(spark, spark.createDataFrame(second, FLIGHTS_RAW), wh, "2026-01-06 00:00:00")
    fct = {r.aircraft_id: r for r in spark.read.parquet(out["fct_path"]).collect()}
    assert set(fct) == {"a1", "a2", "a3"}
    assert fct["a2"].flight_duration_minutes == 300 and str(fct["a2"]._loaded_at) == "2026-01-06 00:00:00"
    assert (fct["a2"].duration_rank_from_airport, fct["a1"].duration_rank_from_airport) == (1, 2)
    assert fct["a3"].duration_rank_from_airport == 1
    assert spark.read.parquet(os.path.join(wh, "flights_stg")).count() == 4
    # re-running the second run with a corrected arrival replaces its own staging, and the fact follows
    second[0] = (*second[0][:5], t("2026-01-03 11:30:00"), *second[0][6:])
    out = jobs.run_flights(spark, spark.createDataFrame(second, FLIGHTS_RAW), wh, "2026-01-06 00:00:00")
    assert spark.read.parquet(os.path.join(wh, "flights_stg")).count() == 4
    fct = {r.aircraft_id: r for r in spark.read.parquet(out["fct_path"]).collect()}
    assert set(fct) == {"a1", "a2", "a3"} and fct["a2"].flight_duration_minutes == 90


def test_cli_pipeline(spark, scratch):
    from aerolake.__main__ import main
    wh = os.path.join(scratch, "wh_cli")
    out = main(["--warehouse", wh, "--tables", SF_SMALL, "--run-ts", "2026-01-01 00:00:00"])
    assert out["positions"]["clean_rows"] > 0 and out["flights"]["fct_path"].endswith("version=000001")
    res = spark.read.parquet(out["quality_results"]).filter("failing_rows > 0")
    failing = {(r.test, r.model, r.column_name) for r in res.collect()}
    assert ("accepted_range", "stg_flights", "departure_horiz_distance_m") in failing
    assert out["failing_checks"] == len(failing)


def test_cli_file_sources(spark, scratch):
    import gzip
    import io
    import json
    import tarfile
    from aerolake.__main__ import main
    base = 1767398400.0  # 2026-01-03 00:00:00 UTC
    doc = {"icao": "3c6444", "r": "D-AIBL", "t": "A319", "desc": "AIRBUS A-319", "timestamp": base,
           "trace": [[60.0, 50.0, 8.5, 1200, 0, 0, 0, 0, {"flight": "DLH4 ", "squawk": "1000"}],
                     [7200.0, 50.5, 8.9, 36000, 0, 0, 0, 0, None]]}
    tj = os.path.join(scratch, "tj")
    os.makedirs(tj)
    with open(os.path.join(tj, "a.json"), "w") as f:
        json.dump(doc, f)
    ta = os.path.join(scratch, "ta")
    os.makedirs(ta)
    payload = gzip.compress(json.dumps(dict(doc, icao="4ca123")).encode())
    with tarfile.open(os.path.join(ta, "day.tar"), "w") as tar:
        for name, data in (("./traces/23/trace_full_4ca123.json", payload), ("./traces/24/bad.json", b"xx")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    sj = os.path.join(scratch, "sj")
    os.makedirs(sj)
    with open(os.path.join(sj, "s.json"), "w") as f:
        json.dump({"time": 1767398400, "states": [["3c6444", "DLH4 ", "Germany", 1767398400, 1767398400, 8.5, 50.0,
                                                     365.8, False, 120.0, 90.0, 0.0, None, 380.0, "1000", False, 0]]}, f)
    fb = os.path.join(scratch, "fb")
    os.makedirs(fb)
    with open(os.path.join(fb, "flights_batch_1767398400_1_1.json"), "w") as f:
        json.dump([{"icao24": "3c6444", "firstSeen": 1767398460, "estDepartureAirport": "EDDF",
                    "lastSeen": 1767405600, "estArrivalAirport": "EDDM", "callsign": "DLH4    ",
                    "estDepartureAirportHorizDistance": 900.0, "estArrivalAirportHorizDistance": 1200.0}], f)
    wh = os.path.join(scratch, "wh_files")
    out = main(["--warehouse", wh, "--trace-json", tj, "--trace-archives", ta, "--states-json", sj,
                "--flight-batches", fb, "--run-ts", "2026-01-04 00:00:00"])
    assert out["positions"]["clean_rows"] == 4
    assert spark.read.parquet(os.path.join(wh, "quarantine", "trace_members")).count() == 1
    assert spark.read.parquet(os.path.join(wh, "states")).first().callsign == "DLH4"
    fct = spark.read.parquet(out["flights"]["fct_path"]).first()
    assert fct.flight_duration_minutes == 119 and fct.departure_airport_key is not None
    aggs = spark.read.parquet(os.path.join(wh, "agg_daily_traffic")).first()
    assert (aggs.position_count, aggs.unique_aircraft) == (4, 2)


def _t(s):
    import datetime as dt
    return int(dt.datetime.fromisoformat(s).replace(tzinfo=dt.timezone.utc).timestamp())


def _flights(spark, *rows):
    import datetime as dt
    from aerolake.schemas import FLIGHTS_RAW
    made = [(a, f"F{a}", dep, arr, _t(f"2026-01-03 {start}"), _t(f"2026-01-03 {end}"), 1.0, 1.0, dt.datetime(2026, 1, 4)) for a, dep, arr, start, end in rows]
    return spark.createDataFrame(made, FLIGHTS_RAW)


def _fact(spark, path):
    cols = ["aircraft_id", "departure_time", "arrival_time", "departure_airport_key", "departure_date_key", "flight_duration_minutes", "duration_rank_from_airport", "_loaded_at"]
    return sorted((tuple(r) for r in spark.read.parquet(path).select(*cols).collect()), key=str)


def test_run_tags_differ_to_the_last_digit():
    stamps = ["2026-01-05 00:00:00.1", "2026-01-05 00:00:00.9", "2026-01-05 00:00:00", "2026-01-05T00:00:00", "2026-01-05 00:00:00+01:00", "2026-01-05 00:00:00-01:00"]
    assert len({jobs.run_tag(s) for s in stamps}) == len(stamps)


def test_any_cut_into_runs_equals_one_build(spark, scratch):
    """Moved airports, changed arrivals, repeated rows, a back-dated stamp, two stamps in one second, and runs that died
    after staging (the first and a middle one): every staged flight is there and ranks are those of a full build."""
    batches = [
        ("2026-01-05 00:00:00.1", [("a1", "EA", "EB", "10:00:00", "12:00:00"), ("a2", "EA", "EB", "10:00:00", "11:00:00")]),
        ("2026-01-05 00:00:00.9", [("a3", "EA", "EB", "09:00:00", "09:30:00"), ("a1", "EA", "EB", "10:00:00", "12:00:00")]),
        ("2026-01-06 00:00:00", [("a1", "EX", "EB", "10:00:00", "12:00:00"), ("a4", None, "EB", "10:00:00", "12:00:00")]),
        ("2026-01-04 00:00:00", [("a5", "EX", "EB", "10:00:00", "10:05:00"), ("a2", "EA", "EB", "10:00:00", "10:40:00")]),
        ("2026-01-07 00:00:00", [("a2", "EA", "EB", "10:00:00", "15:00:00")]),
    ]
    whole, parts = os.path.join(scratch, "one"), os.path.join(scratch, "cut")
    commit, dies = jobs.INC.commit_version, {0, 2}
    for k, (stamp, rows) in enumerate(batches):
        if k in dies:
            def lost(*a, **b):
                raise RuntimeError("lost before the commit")
            jobs.INC.commit_version = lost
        try:
            cut = jobs.run_flights(spark, _flights(spark, *rows), parts, stamp)
        except RuntimeError:
            assert k in dies
        finally:
            jobs.INC.commit_version = commit
    for stamp, rows in batches:
        full = jobs.run_flights(spark, _flights(spark, *rows), whole, stamp, incremental=False)
    assert spark.read.parquet(f"{parts}/flights_stg").count() == 9
    got = _fact(spark, cut["fct_path"])
    assert got == _fact(spark, full["fct_path"]) and {r[0] for r in got} == {"a1", "a2", "a3", "a4", "a5"}
    ranks = {r[0]: (r[5], r[6]) for r in got}
    assert ranks == {"a1": (120, 1), "a2": (300, 1), "a3": (30, 6), "a4": (120, 1), "a5": (5, 2)}


def test_full_refresh_keeps_earlier_runs_and_calendar_follows_the_data(spark, scratch):
    wh = os.path.join(scratch, "full")
    jobs.run_flights(spark, _flights(spark, ("a1", "EA", "EB", "10:00:00", "12:00:00")), wh, "2026-01-05 00:00:00")
    late = _flights(spark, ("a2", "EA", "EB", "10:00:00", "11:00:00"))
    from pyspark.sql import functions as F
    late = late.withColumns({c: F.col(c) + 365 * 86400 for c in ("firstseen", "lastseen")})
    out = jobs.run_flights(spark, late, wh, "2026-01-06 00:00:00", incremental=False)
    rows = spark.read.parquet(out["fct_path"]).collect()
    assert {r.aircraft_id for r in rows} == {"a1", "a2"} and all(r.departure_date_key for r in rows)


def test_positions_accumulate_by_date(spark, scratch):
    from pyspark.sql import functions as F
    raw = Models(spark, SF_SMALL).positions_raw
    first = raw.select(F.to_date(F.min("event_datetime"))).first()[0]
    raw = raw.filter(F.to_date("event_datetime") < F.date_add(F.lit(first), 2)).withColumn("k", F.pmod(F.hash("event_datetime", "icao24"), F.lit(2))).cache()
    one, cut = os.path.join(scratch, "one"), os.path.join(scratch, "cut")
    jobs.run_positions(spark, raw.drop("k"), one, "a")
    for k in range(2):
        jobs.run_positions(spark, raw.filter(F.col("k") == k).drop("k"), cut, f"run {k}")
    tables = ["positions_clean", "positions_silver", "fact_positions", "dim_aircraft", "dim_dates", "agg_daily_traffic", "agg_traffic_grid"]

    def rows(wh, name):
        df = spark.read.parquet(f"{wh}/{name}")
        return sorted(map(str, df.select(*sorted(df.columns)).collect()))

    assert all(rows(one, t) == rows(cut, t) for t in tables)
    # another day leaves the other days' files alone
    day = raw.select(F.to_date(F.max("event_datetime"))).first()[0]

    def files(wh):
        return {f for f in spark.read.parquet(f"{wh}/positions_clean").filter(F.col("event_date") != day).inputFiles() if f"event_date={day}" not in f}

    held = files(cut)
    jobs.run_positions(spark, raw.filter(F.to_date("event_datetime") == day).drop("k"), cut, "again")
    assert files(cut) == held and all(rows(one, t) == rows(cut, t) for t in tables)
    # a run that is repeated with less takes back what it had delivered
    for k in range(2):
        jobs.run_positions(spark, raw.filter((F.col("k") == k) & (F.to_date("event_datetime") < day)).drop("k"), cut, f"run {k}")
    jobs.run_positions(spark, raw.filter("false").drop("k"), cut, "again")
    assert spark.read.parquet(f"{cut}/agg_daily_traffic").filter(F.col("event_date") == day).isEmpty()


def test_keys_are_decided_within_their_date(spark, scratch):
    """Null timestamps on two dates: one run or two leave the same rows, one a date."""
    from pyspark.sql import functions as F
    raw = Models(spark, SF_SMALL).positions_raw
    first = raw.select(F.to_date(F.min("event_datetime"))).first()[0]
    day = F.to_date("event_datetime")
    raw = raw.filter(day < F.date_add(F.lit(first), 2)).withColumn("icao24", F.lit("abc123"))
    raw = raw.withColumn("event_timestamp", F.lit(None).cast(raw.schema["event_timestamp"].dataType)).cache()
    one, cut = os.path.join(scratch, "one_date"), os.path.join(scratch, "cut_date")
    jobs.run_positions(spark, raw, one, "a")
    jobs.run_positions(spark, raw.filter(day == F.lit(first)), cut, "a")
    jobs.run_positions(spark, raw.filter(day != F.lit(first)), cut, "b")

    def rows(wh):
        df = spark.read.parquet(f"{wh}/positions_clean")
        return sorted(map(str, df.select(*sorted(df.columns)).collect()))

    assert len(rows(one)) == 2 and rows(one) == rows(cut)


def test_dedup_does_not_depend_on_input_order(spark):
    from pyspark.sql import functions as F
    from aerolake.operators import flights as FL
    from aerolake.operators import positions as P
    m = Models(spark, SF_SMALL)
    raw = m.positions_raw.limit(300)
    twins = raw.unionByName(raw.withColumn("description", F.lit("other"))).unionByName(raw.withColumn("source", F.lit("b"))).cache()
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(P.clean_positions(twins.orderBy("description", "source"))) == rows(P.clean_positions(twins.orderBy(F.desc("source"), F.rand(1)).coalesce(1)))
    stg = m.stg_flights.limit(300)
    twins = stg.unionByName(stg.withColumn("processed_at", F.lit("2020-01-01").cast("timestamp_ntz"))).cache()
    cal = FL.calendar_for(stg)
    assert rows(FL.build_flight_base(twins.orderBy("processed_at"), cal)) == rows(FL.build_flight_base(twins.orderBy(F.desc("processed_at")), cal))
