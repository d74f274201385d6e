"""Keyed upsert, versioned commits and incremental file pickup."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from aerolake.operators import incremental as INC
from aerolake.streaming import ingest as ING
from aerolake.streaming import live as LIVE

SCHEMA = "aircraft_id string, departure_time string, arrival string, _loaded_at int"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_same_batch_twice_is_idempotent(spark):
    existing = _df(spark, [("a", "d1", "x", 1), ("b", "d1", "y", 1)])
    batch = _df(spark, [("a", "d1", "x2", 2), ("c", "d1", "z", 2)])
    keys = ["aircraft_id", "departure_time"]
    once = INC.upsert_by_key(existing, batch, keys, "_loaded_at")
    twice = INC.upsert_by_key(once, batch, keys, "_loaded_at")
    assert _rows(once) == [("a", "d1", "x2", 2), ("b", "d1", "y", 1), ("c", "d1", "z", 2)]
    assert _rows(twice) == _rows(once)


def test_upsert_empty_target_loads_all_and_null_keys_match(spark):
    empty = _df(spark, [])
    batch = _df(spark, [("a", None, "x", 1), ("a", None, "x-late", 2)])
    out = INC.upsert_by_key(empty, batch, ["aircraft_id", "departure_time"], "_loaded_at")
    assert _rows(out) == [("a", None, "x-late", 2)]
    again = INC.upsert_by_key(out, _df(spark, [("a", None, "x3", 3)]), ["aircraft_id", "departure_time"], "_loaded_at")
    assert _rows(again) == [("a", None, "x3", 3)]


def test_commit_versions(spark, scratch):
    base = os.path.join(scratch, "fct")
    assert INC.read_latest(spark, base) is None
    INC.commit_version(spark, _df(spark, [("a", "d1", "x", 1)]), base)
    v1 = INC.read_latest(spark, base)
    INC.commit_version(spark, INC.upsert_by_key(v1, _df(spark, [("a", "d1", "y", 2)]), ["aircraft_id", "departure_time"],
                                                "_loaded_at"), base)
    assert INC.list_versions(spark, base) == [1, 2]
    assert _rows(INC.read_latest(spark, base)) == [("a", "d1", "y", 2)]


def test_ingest_only_new_files(spark, scratch):
    src, out, ck = (os.path.join(scratch, n) for n in ("src", "out", "ck"))
    os.makedirs(src)
    schema = "icao24 string, n int"

    def put(name, rows):
        with open(os.path.join(src, name), "w") as f:
            f.write("\n".join(json.dumps(r) for r in rows))

    put("a.json", [{"icao24": "a", "n": 1}, {"icao24": "b", "n": 2}])
    r1 = ING.ingest_files(spark, src, spark.createDataFrame([], schema).schema, out, ck)
    assert r1["input_rows"] == 2 and spark.read.parquet(out).count() == 2
    put("b.json", [{"icao24": "c", "n": 3}])
    r2 = ING.ingest_files(spark, src, spark.createDataFrame([], schema).schema, out, ck)
    assert r2["input_rows"] == 1 and spark.read.parquet(out).count() == 3
    r3 = ING.ingest_files(spark, src, spark.createDataFrame([], schema).schema, out, ck)
    assert r3["input_rows"] == 0 and spark.read.parquet(out).count() == 3


def test_every_trigger_is_counted(spark, scratch):
    src = os.path.join(scratch, "many")
    os.makedirs(src)
    for i in range(6):
        with open(os.path.join(src, f"f{i}.json"), "w") as f:
            f.write(json.dumps({"k": i}))
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        got = ING.ingest_files(spark, src, spark.createDataFrame([], "k long").schema, os.path.join(scratch, "many_out"),
                               os.path.join(scratch, "many_ck"), max_files_per_trigger=1)
        up = ING.upsert_files(spark, src, spark.createDataFrame([], "k long").schema, os.path.join(scratch, "many_ck2"),
                              lambda df, batch: None, options={"maxFilesPerTrigger": "1"})
        assert spark.conf.get(key) == "2"
    finally:
        spark.conf.set(key, before)
    assert got["input_rows"] == 6 and got["batches"] >= 6
    assert up["batches"] >= 6


def test_upsert_stream_into_versions(spark, scratch):
    src, base, ck = (os.path.join(scratch, n) for n in ("src2", "tbl", "ck2"))
    os.makedirs(src)
    schema = spark.createDataFrame([], SCHEMA).schema
    keys = ["aircraft_id", "departure_time"]

    def merge(batch, batch_id):
        cur = INC.read_latest(spark, base, schema)
        cur = cur if cur is not None else spark.createDataFrame([], schema)
        INC.commit_version(spark, INC.upsert_by_key(cur, batch, keys, "_loaded_at"), base)

    with open(os.path.join(src, "1.json"), "w") as f:
        f.write(json.dumps({"aircraft_id": "a", "departure_time": "d1", "arrival": "x", "_loaded_at": 1}))
    ING.upsert_files(spark, src, schema, ck, merge)
    with open(os.path.join(src, "2.json"), "w") as f:
        f.write(json.dumps({"aircraft_id": "a", "departure_time": "d1", "arrival": "y", "_loaded_at": 2}))
    ING.upsert_files(spark, src, schema, ck, merge)
    assert _rows(INC.read_latest(spark, base)) == [("a", "d1", "y", 2)]


def test_streaming_hourly_and_sessions(spark, scratch):
    src = os.path.join(scratch, "pos")
    os.makedirs(src)
    base = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = []
    for i, minutes in enumerate([0, 5, 5, 50, 130, 300]):
        t = base + dt.timedelta(minutes=minutes)
        rows.append({"icao24": "A", "event_timestamp": int(t.timestamp()),
                     "event_datetime": t.isoformat(), "on_ground": 0})
    with open(os.path.join(src, "p.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))
    schema = "icao24 string, event_timestamp long, event_datetime timestamp_ntz, on_ground int"
    stream = ING.read_new_files(spark, src, spark.createDataFrame([], schema).schema)
    q = (LIVE.hourly_traffic_stream(stream).writeStream.format("memory").queryName("hourly_t")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.hour_start.hour: r.position_count for r in spark.table("hourly_t").collect()}
    assert got.get(10) == 3 and got.get(12) == 1   # duplicate at minute 5 dropped; 15:00 still open
    q2 = (LIVE.sessions_stream(ING.read_new_files(spark, src, spark.createDataFrame([], schema).schema))
          .writeStream.format("memory").queryName("sess_t").outputMode("append")
          .trigger(availableNow=True).start())
    q2.awaitTermination()
    sizes = sorted(r.positions for r in spark.table("sess_t").collect())
    # sessions close after 30 min of silence once the watermark passes; 15:00 stays open
    assert sizes == [1, 1, 3]


def test_commit_after_failed_attempt(spark, scratch):
    base = os.path.join(scratch, "fct_fail")
    INC.commit_version(spark, _df(spark, [("a", "d1", "x", 1)]), base)
    os.makedirs(os.path.join(base, "version=000002"))          # a crashed attempt, no _SUCCESS
    assert INC.list_versions(spark, base) == [1]
    assert _rows(INC.read_latest(spark, base)) == [("a", "d1", "x", 1)]
    path = INC.commit_version(spark, _df(spark, [("b", "d1", "y", 2)]), base)
    assert path.endswith("version=000003")
    assert _rows(INC.read_latest(spark, base)) == [("b", "d1", "y", 2)]
