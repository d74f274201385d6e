"""Bookmarked delivery through the command line: files are taken once, whatever dies in between."""

import gzip
import io
import json
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from aerolake.__main__ import main
from aerolake.operators import positions as P
from aerolake.plans import jobs
from aerolake.plans.catalog import Models
from aerolake.sources import archives as AR
from aerolake.streaming.bookmarks import Bookmark
from tests.conftest import SF_SMALL

BASE = 1767398400.0  # 2026-01-03 00:00:00 UTC


def _doc(icao, offset=60.0, day=0):
    return {"icao": icao, "r": "D-X", "t": "A319", "desc": "X", "timestamp": BASE + 86400 * day, "trace": [[offset, 50.0, 8.5, 1200, 0, 0, 0, 0, None]]}


def _put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def _put_flights(folder, n, icao):
    _put(folder, f"flights_batch_1767398400_1_{n}.json", json.dumps([{
        "icao24": icao, "firstSeen": 1767398460 + 60 * n, "estDepartureAirport": "EDDF", "lastSeen": 1767405600, "estArrivalAirport": "EDDM", "callsign": "X"}]))


def _put_tar(folder, name, members):
    os.makedirs(folder, exist_ok=True)
    with tarfile.open(os.path.join(folder, name), "w") as tar:
        for member, data in members:
            info = tarfile.TarInfo(f"./traces/{member}")
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))


def _rows(spark, path):
    df = spark.read.parquet(path)
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_second_run_takes_nothing_and_new_files_once(spark, scratch):
    tj, ta, fb, sj, wh = (os.path.join(scratch, "bm", n) for n in ("tj", "ta", "fb", "sj", "wh"))
    _put(tj, "a.json", json.dumps(_doc("aaaaaa")))
    _put(tj, "bad.json", json.dumps(_doc("bbbbbb"))[:-20])
    _put_tar(ta, "one.tar", [("1.json", gzip.compress(json.dumps(_doc("cccccc")).encode())), ("2.json", b"xx"), ("3.json", gzip.compress(b"no json"))])
    _put_flights(fb, 1, "f1")
    _put(sj, "s.json", json.dumps({"time": 1767398400, "states": [["3c6444", "DLH4 "] + [None] * 15]}))
    _put(sj, "bad.json", "{\"time\": 17")
    call = ["--warehouse", wh, "--trace-json", tj, "--trace-archives", ta, "--flight-batches", fb, "--states-json", sj]
    first = main([*call, "--run-ts", "2026-01-04 00:00:00"])
    assert first["taken"]["trace-json"] == {"raw_rows": 1, "invalid_documents": 1}
    assert first["taken"]["trace-archives"] == {"raw_rows": 1, "invalid_documents": 2}
    assert first["taken"]["states-json"] == {"state_rows": 1, "invalid_documents": 1}
    assert first["taken"]["flight-batches"] == {"stg_rows": 1}
    assert first["positions"]["clean_rows"] == 2
    assert spark.read.parquet(f"{wh}/quarantine/trace_members").count() == 3
    assert spark.read.parquet(f"{wh}/quarantine/states").first().source_file.endswith("bad.json")
    tables = {t: _rows(spark, f"{wh}/{t}") for t in ("positions_clean", "states", "flights_stg", "quarantine/trace_members")}

    second = main([*call, "--run-ts", "2026-01-05 00:00:00"])
    assert all(not r for r in second["taken"].values())
    assert second["positions"] == {"raw_rows": 0, "clean_rows": 0, "silver_rows": 0, "dates": 0} and second["flights"] == {"stg_rows": 0}
    assert {t: _rows(spark, f"{wh}/{t}") for t in tables} == tables

    _put(tj, "b.json", json.dumps(_doc("dddddd", day=1)))
    _put_flights(fb, 2, "f2")
    third = main([*call, "--run-ts", "2026-01-06 00:00:00"])
    assert third["taken"]["trace-json"]["raw_rows"] == 1 and third["positions"]["dates"] == 1
    assert third["taken"]["flight-batches"] == {"stg_rows": 1} and third["flights"]["fct_path"].endswith("version=000002")
    assert spark.read.parquet(third["flights"]["fct_path"]).count() == 2
    assert {r.icao24 for r in spark.read.parquet(f"{wh}/positions_clean").collect()} == {"AAAAAA", "CCCCCC", "DDDDDD"}
    assert spark.read.parquet(f"{wh}/dim_aircraft").count() == 3 and spark.read.parquet(f"{wh}/dim_dates").count() == 2


@pytest.mark.parametrize("where", ["staged, not in the ledger", "in the ledger, not built"])
def test_a_job_that_dies_is_replayed_once(spark, scratch, monkeypatch, where):
    tj, fb, wh = (os.path.join(scratch, "die", where[:6], n) for n in ("tj", "fb", "wh"))
    _put(tj, "a.json", json.dumps(_doc("aaaaaa")))
    _put_flights(fb, 1, "f1")
    call = ["--warehouse", wh, "--trace-json", tj, "--flight-batches", fb]

    def lost(*a, **b):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if where.startswith("staged"):
            m.setattr(Bookmark, "_commit", lost)
        else:
            m.setattr(jobs, "build_positions", lost)
        with pytest.raises(Exception, match="lost"):
            main([*call, "--run-ts", "2026-01-04 00:00:00"])
    assert spark.read.parquet(f"{wh}/positions_raw").count() == 1
    _put(tj, "later.json", json.dumps(_doc("bbbbbb")))  # must not join the replayed batch
    out = main([*call, "--run-ts", "2026-01-05 00:00:00"])
    assert out["positions"]["clean_rows"] == 2 and out["positions"]["dates"] == 1
    assert spark.read.parquet(f"{wh}/positions_raw").count() == 2 and spark.read.parquet(f"{wh}/flights_stg").count() == 1
    assert spark.read.parquet(f"{wh}/positions_raw").select("run").distinct().count() == 2
    assert main([*call, "--run-ts", "2026-01-06 00:00:00"])["positions"]["dates"] == 0


def test_flights_that_are_staged_but_not_built_are_built_by_the_next_run(spark, scratch, monkeypatch):
    fb, wh = os.path.join(scratch, "fl", "fb"), os.path.join(scratch, "fl", "wh")
    _put_flights(fb, 1, "f1")
    with monkeypatch.context() as m:
        m.setattr(jobs, "build_flights", lambda *a, **b: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            main(["--warehouse", wh, "--flight-batches", fb, "--run-ts", "2026-01-04 00:00:00"])
    out = main(["--warehouse", wh, "--flight-batches", fb, "--run-ts", "2026-01-05 00:00:00"])
    assert out["flights"]["stg_rows"] == 0 and spark.read.parquet(out["flights"]["fct_path"]).count() == 1


def test_flat_positions_as_csv_and_parquet(spark, scratch):
    raw = Models(spark, SF_SMALL).positions_raw.limit(300).cache()
    csv, pq, wh = (os.path.join(scratch, "flat", n) for n in ("csv", "pq", "wh"))
    raw.limit(100).write.option("header", True).csv(csv)
    raw.withColumn("icao24", F.upper("icao24")).write.parquet(pq)
    out = main(["--warehouse", wh, "--positions-csv", csv, "--positions-parquet", pq, "--run-ts", "2026-01-04 00:00:00"])
    assert out["taken"]["positions-csv"]["raw_rows"] == 100 and out["taken"]["positions-parquet"]["raw_rows"] == 300
    one = os.path.join(scratch, "flat", "one")
    jobs.run_positions(spark, raw, one)
    # CSV text has no trailing blanks, no empty strings and milliseconds: the same keys and places are compared
    columns = ["icao24", "event_timestamp", "latitude", "longitude", "altitude_band"]
    got, want = (sorted(map(str, spark.read.parquet(f"{x}/positions_clean").select(*columns).collect())) for x in (wh, one))
    assert got == want


def test_empty_first_delivery(spark, scratch):
    wh = os.path.join(scratch, "empty_wh")
    raw = Models(spark, SF_SMALL).positions_raw
    assert jobs.run_positions(spark, raw.filter("false"), wh, "a") == {"raw_rows": 0, "clean_rows": 0, "silver_rows": 0, "dates": 0}
    assert jobs.run_positions(spark, raw.limit(300), wh, "b")["clean_rows"] > 0


def test_dimensions_from_states_of_dates_equal_those_of_all_rows(spark, scratch):
    m, wh = Models(spark, SF_SMALL), os.path.join(scratch, "states_wh")
    raw = m.positions_raw.cache()
    cut = raw.select(F.percentile_approx(F.col("event_timestamp"), 0.5)).first()[0]
    for k, part in enumerate((raw.filter(F.col("event_timestamp") < cut), raw.filter(F.col("event_timestamp") >= cut))):
        jobs.run_positions(spark, part, wh, str(k))
    silver = spark.read.parquet(f"{wh}/positions_silver")
    for name, build in (("dim_aircraft", P.build_dim_aircraft), ("dim_dates", P.build_dim_dates)):
        got, want = spark.read.parquet(f"{wh}/{name}"), build(silver)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_archive_members_are_decoded_once_and_pieces_follow_bytes(spark, scratch, monkeypatch):
    ta, wh = os.path.join(scratch, "arc", "ta"), os.path.join(scratch, "arc", "wh")
    _put_tar(ta, "three.tar", [("1.json", gzip.compress(json.dumps(_doc("aaaaaa")).encode())), ("2.json", b"xx"), ("3.json", gzip.compress(b"no json"))])
    seen = spark.sparkContext.accumulator(0)
    decode = gzip.decompress

    def counted(data):
        seen.add(1)
        return decode(data)

    real = AR._read_members

    def read(batches):
        gzip.decompress = counted
        try:
            yield from real(batches)
        finally:
            gzip.decompress = decode

    monkeypatch.setattr(AR, "_read_members", read)
    got = jobs.stage_archives(spark, AR.list_archives(spark, ta), wh, "r1")
    assert got == {"raw_rows": 1, "invalid_documents": 2} and seen.value == 3
    jobs.stage_archives(spark, AR.list_archives(spark, ta), wh, "r1")  # the same run again replaces its rows
    assert spark.read.parquet(f"{wh}/quarantine/trace_members").count() == 2

    monkeypatch.setattr(AR, "PIECE_BYTES", 1000)
    members = [(f"{i}.json", os.urandom(100 + 50 * (i % 7))) for i in range(60)]
    _put_tar(os.path.join(scratch, "arc", "big"), "b.tar", members)
    listed = next(AR._list_members(iter([__import__("pandas").DataFrame({"path": [os.path.join(scratch, "arc", "big", "b.tar")]})])))
    sums = listed.groupby("piece")["size"].sum()
    assert sums.sum() == sum(len(d) for _, d in members) and sums.max() <= 1000 + 400 and sums.iloc[:-1].min() >= 1000 - 400
    frame = spark.createDataFrame([("a", 40), ("b", 25)], "archive string, size long")
    assert (AR.tasks_for(frame, 30), AR.tasks_for(frame.limit(0), 30)) == (3, 1)
