"""Ingest: nested documents, files, archives, sinks (literal fixtures of FIXTURES.md part C)."""

import gzip
import io
import json
import os
import tarfile

from pyspark.sql import functions as F

from aerolake.operators import positions as P
from aerolake.operators.shaping import flatten_states, flatten_traces, parse_trace_documents
from aerolake.schemas import POSITIONS_CLEAN, RAW_STATES, RAW_TRACE
from aerolake.sources import archives as AR
from aerolake.sources import files as FI
from aerolake.sources import sinks as SK

V17 = ["abc123", "DLH1  ", "Germany", "1700000000", "1700000001", "8.5", "50.1", "1000.0", "false",
       "200.5", "90.0", "-1.5", None, "1100.0", "0632", "false", "0"]


def test_flatten_states(spark):
    rows = [
        (1700000000, [V17, ["def456", "AFR2", "France"]]),  # a 17-vector and a 3-vector
        (1700000000, None),                                   # null states
        (1700000000, []),                                     # empty states
        (1700000000, [V17]),                                  # exact duplicate of the first vector
        (1700000000, [[None, "X", "Y"]]),                     # null key
    ]
    df = spark.createDataFrame(rows, RAW_STATES)
    out = {r.icao24: r for r in flatten_states(df, "2026-01-01 00:00:00").collect()}
    assert set(out) == {"abc123", "def456"}
    a, d = out["abc123"], out["def456"]
    assert a.callsign == "DLH1" and a.time_position == 1700000000 and a.on_ground is False and a.squawk == "0632"
    assert a.latitude == 50.1 and a.position_source == 0 and a.snapshot_time == 1700000000
    assert d.callsign == "AFR2" and d.origin_country == "France" and d.longitude is None and d.spi is None


def _doc(icao, ts, points):
    return {"icao": icao, "r": "D-ABCD", "t": "A320", "desc": "AIRBUS A-320", "timestamp": ts, "trace": points}


def test_flatten_traces_guards(spark):
    meta = {"flight": "DLH1  ", "squawk": "0632"}
    docs = [
        _doc("3c6444", 1700000000.0, [
            [],                                                       # size 0
            [1.0, 50.0, 8.0],                                         # size 3
            [2.5, 50.1, 8.1, 35000],                                  # size 4
            [3.0, 50.2, 8.2, "ground", 0, 0, 1, None, None],          # size 9, altitude text, no meta
            [4.0, 50.3, 8.3, 36000, 450, 90, 0, 0, {"flight": "\tDLH2 \n"}, "adsb_icao", None, None, None, None],
            [5.0, 50.4, 8.4, 36000, 450, 90, 0, 0, meta, "adsb_icao", None, None, None, None],  # size 14
            [None, 50.5, 8.5, 1000],                                  # null offset
            [6.0, None, 8.6, 1000],                                   # null lat
        ]),
        _doc("", 1700000000.0, [[1.0, 1.0, 1.0, 1]]),                 # blank icao
        _doc("abcdef", None, [[1.0, 1.0, 1.0, 1]]),                   # no base time
    ]
    text = spark.createDataFrame([(json.dumps(d),) for d in docs], "doc string")
    out = flatten_traces(parse_trace_documents(text)).orderBy("event_timestamp").collect()
    assert [r.event_timestamp for r in out] == [1700000002.5, 1700000003.0, 1700000004.0, 1700000005.0]
    assert out[0].altitude_ft == 35000.0 and out[0].on_ground is None and out[0].callsign is None
    assert out[1].altitude_ft is None and out[1].on_ground == 1
    assert out[2].callsign == "DLH2" and out[2].squawk is None
    assert out[3].callsign == "DLH1" and out[3].squawk == "0632" and out[3].source == "adsb.lol"
    assert str(out[0].event_datetime) == "2023-11-14 22:13:22.500000"
    clean = P.clean_positions(flatten_traces(parse_trace_documents(text))).collect()
    assert {r.altitude_band for r in clean} == {"Cruise", "Unknown"}


def _tar(path, members):
    with tarfile.open(path, "w") as tar:
        for name, payload in members:
            info = tarfile.TarInfo(name)
            info.size = len(payload)
            tar.addfile(info, io.BytesIO(payload))


def test_trace_archives(spark, scratch):
    good = gzip.compress(json.dumps(_doc("3c6444", 1700000000.0, [[1.0, 50.0, 8.0, 100]])).encode())
    path = os.path.join(scratch, "a.tar")
    _tar(path, [("./traces/44/trace_full_3c6444.json", good),
                ("./traces/45/trace_full_bad.json", b"not gzip"),
                ("./other/readme.json", good)])
    _tar(os.path.join(scratch, "b.tar"), [(f"./traces/{i:02d}/trace_full_{i}.json", good) for i in range(40)])
    with open(os.path.join(scratch, "c.tar"), "wb") as f:
        f.write(b"this is not a tar archive")
    docs = AR.read_trace_archives(spark, AR.list_archives(spark, scratch))
    assert docs.filter(F.col("archive").endswith("b.tar")).filter("error IS NULL").count() == 40
    assert docs.filter(F.col("archive").endswith("c.tar") & F.col("error").isNotNull()).count() == 1
    docs = docs.filter(F.col("archive").endswith("a.tar"))
    rows = docs.orderBy("member").collect()
    assert [(r.member, r.doc is not None, r.error is not None) for r in rows] == [
        ("./traces/44/trace_full_3c6444.json", True, False), ("./traces/45/trace_full_bad.json", False, True)]
    pos = flatten_traces(parse_trace_documents(docs.filter("error IS NULL")))
    c = AR.ingest_counters(docs, pos).first()
    assert (c.documents, c.invalid_files, c.rows, c.aircraft) == (1, 1, 1, 1)


def test_members_that_are_no_json_are_errors(spark, scratch):
    good = _doc("3c6444", 1700000000.0, [[1.0, 50.0, 8.0, 100]])
    texts = {"good": json.dumps(good), "cut": json.dumps(good)[:-20], "words": "not json", "empty": "", "null": "null", "number": "17", "list": "[1, 2]",
             "base": json.dumps({**good, "timestamp": "soon"}), "points": json.dumps({**good, "trace": "none"}), "bare": "{}"}
    _tar(os.path.join(scratch, "j.tar"), [(f"./traces/{k}.json", gzip.compress(v.encode())) for k, v in texts.items()])
    docs = AR.read_trace_archives(spark, [os.path.join(scratch, "j.tar")])
    bad = {r.member for r in docs.filter("error IS NOT NULL").collect() if r.archive.endswith("j.tar")}
    assert bad == {f"./traces/{k}.json" for k in texts if k not in ("good", "bare")}
    c = AR.ingest_counters(docs, flatten_traces(parse_trace_documents(docs.filter("error IS NULL")))).first()
    assert (c.documents, c.invalid_files, c.rows, c.aircraft) == (2, 8, 1, 1)


def test_json_file_readers(spark, scratch):
    sdir = os.path.join(scratch, "states")
    os.makedirs(sdir)
    with open(os.path.join(sdir, "s1.json"), "w") as f:
        json.dump({"time": 1700000000, "states": [[*V17[:5], 8.5, 50.1, 1000.0, False, *V17[9:]]]}, f, indent=2)
    st = flatten_states(FI.read_states_json(spark, sdir), "2026-01-01 00:00:00").first()
    assert st.icao24 == "abc123" and st.longitude == 8.5 and st.on_ground is False
    tdir = os.path.join(scratch, "traces")
    os.makedirs(tdir)
    with open(os.path.join(tdir, "t1.json"), "w") as f:
        json.dump(_doc("3c6444", 1700000000.0, [[1.0, 50.0, 8.0, 100, 0, 0, 0, 0, {"flight": "X1 "}]]), f, indent=2)
    with open(os.path.join(tdir, "t2.json"), "w") as f:
        f.write("{broken")
    raw = FI.read_trace_json(spark, tdir, keep_corrupt=True)
    bad = raw.select("icao", "_corrupt_record").collect()
    assert sum(r._corrupt_record is not None for r in bad) == 1
    tr = flatten_traces(FI.read_trace_json(spark, tdir)).collect()
    assert len(tr) == 1 and tr[0].callsign == "X1"


def test_csv_round_trip_and_partitioned_sink(spark, scratch):
    docs = spark.createDataFrame([(json.dumps(_doc("3c6444", 1700000000.0, [[1.0, 50.0, 8.0, "ground"],
                                                                             [86400.0, 51.0, 9.0, 12000]])),)],
                                 "doc string")
    raw = flatten_traces(parse_trace_documents(docs))
    csv_dir = os.path.join(scratch, "csv")
    SK.write_csv(raw, csv_dir)
    clean = P.clean_positions(FI.read_positions_csv(spark, csv_dir))
    assert clean.count() == 2
    out = os.path.join(scratch, "clean")
    SK.write_partitioned(clean, out, ["event_date"])
    assert sorted(d for d in os.listdir(out) if d.startswith("event_date=")) == [
        "event_date=2023-11-14", "event_date=2023-11-15"]
    back = FI.read_positions_parquet(spark, out)
    one_day = back.filter(F.col("event_date") == "2023-11-15")
    assert one_day.count() == 1
    assert "PartitionFilters: [isnotnull(event_date" in one_day._jdf.queryExecution().executedPlan().toString()
    # dynamic partition overwrite: rewriting one day leaves the other untouched
    SK.write_partitioned(back.filter(F.col("event_date") == "2023-11-15"), out, ["event_date"])
    assert FI.read_positions_parquet(spark, out).count() == 2


def test_flight_batches_and_load_by_name(spark, scratch):
    d = os.path.join(scratch, "raw")
    os.makedirs(d)
    rec = {"icao24": "abc123", "firstSeen": 1700000000, "estDepartureAirport": "EDDF", "lastSeen": 1700003600,
           "estArrivalAirport": "LFPG", "callsign": "DLH1  ", "estDepartureAirportHorizDistance": 500.0,
           "estArrivalAirportHorizDistance": 800.0}
    with open(os.path.join(d, "flights_batch_1700000000_12_2.json"), "w") as f:
        json.dump([rec, dict(rec, icao24="def456")], f)
    with open(os.path.join(d, "ignore.json"), "w") as f:
        json.dump([rec], f)
    b = FI.read_flight_batches(spark, d)
    rows = b.collect()
    assert len(rows) == 2 and rows[0].run_id == 1700000000 and rows[0].window_no == 2
    assert "estdepartureairport" in b.columns
    from aerolake.schemas import FLIGHTS_RAW
    upper = b.select([F.col(c).alias(c.upper()) for c in b.columns])
    aligned = SK.align_by_name(upper, FLIGHTS_RAW)
    assert aligned.columns == [f.name for f in FLIGHTS_RAW.fields]
    r = aligned.first()
    assert r.estdepartureairport == "EDDF" and r.processed_at is None
    tbl = os.path.join(scratch, "tbl")
    SK.load_by_name(upper, tbl, FLIGHTS_RAW)
    SK.load_by_name(upper.drop("CALLSIGN"), tbl, FLIGHTS_RAW)
    assert spark.read.parquet(tbl).filter("callsign IS NULL").count() == 2


def test_raw_partitioned_paths(spark, scratch):
    import datetime as dt
    df = spark.createDataFrame([(1, dt.datetime(2026, 9, 16, 10, 30))], "id int, ts timestamp_ntz")
    out = os.path.join(scratch, "rawp")
    SK.write_raw_partitioned(df, out, "ts")
    assert os.path.isdir(os.path.join(out, "year=2026", "month=09", "day=16"))


def test_partitioned_write_splits_a_busy_date(spark, scratch):
    import datetime as dt
    rows = [(i, dt.date(2024, 1, 1) if i % 10 else dt.date(2024, 1, 2)) for i in range(20000)]
    df = spark.createDataFrame(rows, "id long, event_date date")
    out = os.path.join(scratch, "busy")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        SK.write_partitioned(df, out, ["event_date"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")
    busy = [f for f in os.listdir(os.path.join(out, "event_date=2024-01-01")) if f.endswith(".parquet")]
    assert len(busy) > 1
    assert spark.read.parquet(out).count() == 20000
