"""Run the batch pipeline: ``python -m aerolake --warehouse PATH [sources...]``.

Sources (any combination):
  --tables DIR             driver-style table directory (positions from events, flights from orders)
  --trace-archives DIR     tar archives of gzipped trace JSON
  --trace-json DIR         unpacked trace JSON documents
  --positions-csv DIR      flat positions as CSV text with a header
  --positions-parquet DIR  flat positions as Parquet
  --states-json DIR        state-vector snapshot documents (written to <warehouse>/states)
  --flight-batches DIR     flight-record batches (JSON arrays)
Folders of files are bookmarked: a run takes the files that no earlier run into this warehouse has taken.
Documents that can't be read go to <warehouse>/quarantine.
  --publish DATABASE       catalog tables over the written layers, and positions bucketed by (aircraft, hour)
Then the declared data-quality checks run over the written tables; their summary rows are
appended to <warehouse>/quality_results and the number of failing checks is printed.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import functions as F

from aerolake.plans import jobs
from aerolake.plans.catalog import Models
from aerolake.session import get_session
from aerolake.sources import files
from aerolake.sources.sinks import write_parquet
from aerolake.streaming.bookmarks import Bookmark


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="aerolake", description="Run the batch pipeline into a warehouse folder.")
    ap.add_argument("--warehouse", required=True, help="output root (shared storage on a cluster)")
    ap.add_argument("--tables", help="driver-style table directory (events -> positions, orders -> flights)")
    ap.add_argument("--trace-archives", help="directory of .tar archives of gzipped trace JSON")
    ap.add_argument("--trace-json", help="directory of unpacked trace JSON documents")
    ap.add_argument("--positions-csv", help="directory of flat positions as CSV with a header")
    ap.add_argument("--positions-parquet", help="directory of flat positions as Parquet")
    ap.add_argument("--states-json", help="directory of state-vector snapshot documents")
    ap.add_argument("--flight-batches", help="directory of flights_batch_*.json record batches")
    ap.add_argument("--run-ts", default=None, help="run stamp 'YYYY-MM-DD HH:MM:SS' (default: now, UTC)")
    ap.add_argument("--calendar", nargs=2, metavar=("FROM", "TO"), help="bounds of the flight calendar, TO excluded (default: the staged departures)")
    ap.add_argument("--flights-by-day", action="store_true", help="keep the flights fact as a manifest table by departure day as well")
    ap.add_argument("--publish", metavar="DATABASE", default=None, help="create catalog tables over the written layers in this database")
    ap.add_argument("--master", default=None, help="Spark master for local runs (default: from spark-submit)")
    a = ap.parse_args(argv)
    run_ts = a.run_ts or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    spark = get_session(app="aerolake-pipeline", master=a.master)
    out: dict = {"run_ts": run_ts}

    wh, files_taken = a.warehouse, {}

    def take(name: str, folder: str | None, stream, stage) -> None:
        """Hand the new files of a folder to ``stage``; results are summed by name."""
        if folder:
            results = Bookmark(spark, wh, name, folder).deliver(stream(folder), stage)
            files_taken[name] = {k: sum(r[k] for r in results) for k in (results[0] if results else ())}

    if a.tables:
        files_taken["tables"] = jobs.stage_positions(spark, Models(spark, a.tables).positions_raw, wh, run_ts)
    take("trace-archives", a.trace_archives, lambda p: files.stream_paths(spark, p, "*.tar"),
         lambda rows, run: jobs.stage_archives(rows.sparkSession, rows, wh, run))
    take("trace-json", a.trace_json, lambda p: files.stream_trace_json(spark, p),
         lambda rows, run: jobs.stage_documents(rows.sparkSession, rows, wh, run))
    for name, folder, stream in (("positions-csv", a.positions_csv, files.stream_positions_csv), ("positions-parquet", a.positions_parquet, files.stream_positions_parquet)):
        take(name, folder, lambda p, stream=stream: stream(spark, p), lambda rows, run: jobs.stage_positions(rows.sparkSession, rows, wh, run))
    positions = [a.tables, a.trace_archives, a.trace_json, a.positions_csv, a.positions_parquet]
    if any(positions):
        built = jobs.build_positions(spark, wh)
        out["positions"] = {"raw_rows": sum(r.get("raw_rows", 0) for r in files_taken.values()), **built}

    take("states-json", a.states_json, lambda p: files.stream_states_json(spark, p),
         lambda rows, run: jobs.stage_states(rows.sparkSession, rows, wh, run, run_ts))

    flights = [a.tables, a.flight_batches]
    if any(flights):
        staged = 0
        if a.tables:
            staged += jobs.stage_flights(spark, Models(spark, a.tables).flights_raw, wh, run_ts)["stg_rows"]
        take("flight-batches", a.flight_batches, lambda p: files.stream_flight_batches(spark, p),
             lambda rows, run: jobs.stage_flights(rows.sparkSession, rows.withColumn("processed_at", F.lit(run_ts).cast("timestamp_ntz")), wh, run_ts, run))
        staged += files_taken.get("flight-batches", {}).get("stg_rows", 0)
        out["flights"] = {"stg_rows": staged}
        if jobs.pending_flights(spark, wh):
            out["flights"].update(jobs.build_flights(spark, wh, tuple(a.calendar) if a.calendar else None))
        if a.flights_by_day:
            out["flights_by_day"] = jobs.build_flights_by_day(spark, wh, tuple(a.calendar) if a.calendar else None)
    out["taken"] = files_taken
    if a.publish:
        out["published"] = jobs.publish_tables(spark, wh, a.publish)
    if any(positions) or any(flights):
        results = f"{a.warehouse}/quality_results"
        write_parquet(jobs.run_quality(spark, a.warehouse).withColumn("run_ts", F.lit(run_ts)), results, mode="append")
        out["quality_results"] = results
        out["failing_checks"] = spark.read.parquet(results).filter(
            (F.col("run_ts") == run_ts) & (F.col("failing_rows") > 0)).count()
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
