"""Batch jobs: run the models over files and write each layer once.

Layout under ``warehouse``::

    positions_raw/run=.../event_date=...  valid rows as delivered
    positions_pending/run=...        runs whose dates aren't downstream yet
    trace_members, trace_documents, states/run=..., quarantine/.../run=...
    positions_clean/event_date=...   bronze (cleaned, deduplicated positions)
    positions_silver/event_date=...  silver
    fact_positions/event_date=...    gold fact
    dim_aircraft_states/event_date=... (latest row per aircraft and date)
    dim_aircraft, dim_dates, dim_time (gold), agg_*/event_date=...
    flights_stg/run=..., dim_airports, dim_date
    fct_flights_runs/version=N, fct_flights_durations/version=N, fct_flights/version=N (commits the three)

    quality_measures/<model>, quarantine/checks/<model>/scope=... (row-level checks, counted on the writes)

Downstream models read the written layer back (a cut in lineage and a re-usable scan),
instead of recomputing the whole chain per output.  Row counts come from ``observe`` on the
write itself, not from extra passes over the data.
"""

from __future__ import annotations

import datetime as dt
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.operators import aggregates as A
from aerolake.operators import flights as FL
from aerolake.operators import incremental as INC
from aerolake.operators import positions as P
from aerolake.operators import quality as DQ
from aerolake.operators.shaping import flatten_states, flatten_traces
from aerolake.plans.measures import Measures
from aerolake.schemas import POSITIONS_CLEAN, POSITIONS_STORED
from aerolake.sources import archives, catalog
from aerolake.sources.files import read_positions_parquet
from aerolake.sources.manifest import ManifestTable
from aerolake.sources.sinks import write_parquet, write_partitioned


AGGREGATES = (("agg_daily_traffic", A.agg_daily_traffic), ("agg_hourly_traffic", A.agg_hourly_traffic),
              ("agg_altitude_distribution", A.agg_altitude_distribution),
              ("agg_traffic_grid", A.agg_traffic_grid), ("agg_aircraft_activity", A.agg_aircraft_activity))
#: Each date's latest row per aircraft; the dimensions are merged from these.
AIRCRAFT_STATES = "dim_aircraft_states"
#: Tables with a folder for each date.
DATED = ("positions_clean", "positions_silver", "fact_positions", *(name for name, _ in AGGREGATES))


#: Model names of tables that are called otherwise.
MODELS = {"positions_clean": "clean_positions", "positions_silver": "stg_positions", "flights_stg": "stg_flights"}


def _write_whole(measures: Measures, table: str, df: DataFrame) -> None:
    path = f"{measures.root}/{table}"
    measures.write(table, df, lambda rows: write_parquet(rows, path), lambda: measures.spark.read.parquet(path))


def _observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def _rows(obs: Observation) -> int:
    """Rows counted by an observation; 0 where Spark knew the frame to be empty and dropped it from the plan."""
    try:
        return obs.get.get("rows", 0)
    except Py4JJavaError:
        return 0


def run_positions(spark: SparkSession, raw: DataFrame, warehouse: str, run: str | None = None) -> dict:
    """raw positions -> store -> bronze -> silver -> fact -> dims and aggregates; returns row counts of the batch.

    Valid rows are appended to ``positions_raw`` under the run's own folder, by date; running the same ``run`` again
    replaces what it had stored.  Every downstream table of a date is then rebuilt from all stored rows
    of that date, for the dates the batch touches (or touched before); other dates' files stay as they are.
    """
    return {**stage_positions(spark, raw, warehouse, run), **build_positions(spark, warehouse)}


def stage_positions(spark: SparkSession, raw: DataFrame, warehouse: str, run: str | None = None) -> dict:
    """Store the valid rows of a run; the run stays in ``positions_pending`` until ``build_positions`` has its dates downstream.

    The entry names the dates that the run had stored before, and is written first: a job that dies anywhere in between
    leaves them, and the dates stored by then, to the next build.
    """
    wh = warehouse.rstrip("/")
    tag = run_tag(run) if run else "r" + uuid.uuid4().hex
    own, pending = f"{wh}/positions_raw/run={tag}", f"{wh}/positions_pending/run={tag}"
    before = _dates_of(spark, own)
    if INC.exists(spark, f"{pending}/_SUCCESS"):
        before = sorted({*before, *_values(spark.read.schema("event_date date").parquet(pending))})  # days of one run
    write_parquet(spark.createDataFrame([(d,) for d in before], "event_date date").coalesce(1), pending)
    raw_o, raw_obs = _observed(raw, "raw")
    store = P.normalise_positions(raw_o).withColumn("event_date", F.to_date("event_datetime"))
    write_partitioned(store, own, ["event_date"], static=True)
    return {"raw_rows": _rows(raw_obs)}


def build_positions(spark: SparkSession, warehouse: str) -> dict:
    """Rebuild the downstream tables of all dates of pending runs; without any, nothing is written."""
    wh = warehouse.rstrip("/")
    measures = Measures(spark, wh)
    runs = INC.partitions(spark, f"{wh}/positions_pending", "run")
    before, now = set(), set()
    for tag in runs:
        before |= _values(spark.read.schema("event_date date").parquet(f"{wh}/positions_pending/run={tag}"))  # days of one run
        now |= set(_dates_of(spark, f"{wh}/positions_raw/run={tag}"))
    dates = sorted(before | now)
    for d in before - now:  # rows taken back: a date that no run has any more goes downstream too
        if not INC.matches(spark, f"{wh}/positions_raw/run=*/event_date={d}"):
            INC.remove(spark, [f"{wh}/{t}/event_date={d}" for t in (*DATED, AIRCRAFT_STATES)])
            for t in DATED:
                measures.forget(MODELS.get(t, t), [str(d)])
    counts = {"clean_rows": 0, "silver_rows": 0, "dates": len(dates)}
    if dates:
        of_dates = F.col("event_date").isin(dates)
        stored = read_positions_parquet(spark, f"{wh}/positions_raw", POSITIONS_STORED).filter(of_dates)

        def dated(table: str, df: DataFrame) -> int:
            """Replace the dates of a table; the number of rows written."""
            return measures.write(MODELS.get(table, table), df, lambda rows: write_partitioned(rows, f"{wh}/{table}", ["event_date"]),
                                  lambda: spark.read.parquet(f"{wh}/{table}").filter(of_dates), [str(d) for d in dates], F.col("event_date").cast("string"))

        clean_rows = dated("positions_clean", P.clean_positions(stored.drop("run", "event_date"), within_date=True))
        clean = read_positions_parquet(spark, f"{wh}/positions_clean", POSITIONS_CLEAN).filter(of_dates)
        silver_rows = dated("positions_silver", P.standardise_positions(clean))
        silver = spark.read.parquet(f"{wh}/positions_silver").filter(of_dates)
        dated("fact_positions", P.build_fact(silver))
        fact = spark.read.parquet(f"{wh}/fact_positions").filter(of_dates)
        write_partitioned(P.aircraft_states(silver), f"{wh}/{AIRCRAFT_STATES}", ["event_date"])
        states = spark.read.parquet(f"{wh}/{AIRCRAFT_STATES}")  # a row an aircraft and date, of all dates
        _write_whole(measures, "dim_aircraft", P.build_dim_aircraft(states))
        _write_whole(measures, "dim_dates", P.build_dim_dates(states))
        _write_whole(measures, "dim_time", P.build_dim_time(spark))
        for name, fn in AGGREGATES:
            dated(name, fn(fact))
        counts.update(clean_rows=clean_rows, silver_rows=silver_rows)
    INC.remove(spark, [f"{wh}/positions_pending/run={tag}" for tag in runs])
    return counts


def publish_tables(spark: SparkSession, warehouse: str, database: str, buckets: int | None = None) -> list[str]:
    """Tables of the catalog over the layers that are written so far; ``positions_by_hour`` holds silver positions bucketed by (aircraft, hour).

    The flights fact is published as its latest version.  ``buckets`` defaults to the session's shuffle partitions.
    """
    wh = warehouse.rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    found = [(name, f"{wh}/{name}", ["event_date"] if name in DATED else []) for name in (*DATED, "dim_aircraft", "dim_dates", "dim_time", "dim_airports", "dim_date")]
    versions = INC.list_versions(spark, f"{wh}/fct_flights")
    if versions:
        found.append(("fct_flights", INC.version_path(f"{wh}/fct_flights", versions[-1]), []))
    done = []
    for name, path, parts in found:
        if INC.exists(spark, path):
            catalog.publish(spark, database, name, path, parts)
            done.append(name)
    if "positions_silver" in done:
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        catalog.save_bucketed_positions(spark.table(f"{database}.positions_silver"), f"{database}.positions_by_hour", n)
        done.append("positions_by_hour")
    return done


def stage_documents(spark: SparkSession, docs: DataFrame, warehouse: str, run: str) -> dict:
    """Trace documents (archive, member, error, parsed fields) -> positions of the run, and its documents with an error in quarantine.

    The documents are written once and read back for both, so that nothing is read, decompressed or parsed twice; a run that is staged
    again replaces its documents, its quarantine and its positions.
    """
    wh, tag = warehouse.rstrip("/"), run_tag(run)
    path = f"{wh}/trace_documents/run={tag}"
    write_parquet(docs, path)
    kept = spark.read.schema(docs.schema).parquet(path)
    bad_o, bad_obs = _observed(kept.filter(F.col("error").isNotNull()).select("archive", "member", "error"), "bad")
    bad_o.write.mode("overwrite").parquet(f"{wh}/quarantine/trace_members/run={tag}")
    staged = stage_positions(spark, flatten_traces(kept.filter(F.col("error").isNull())), warehouse, run)
    return {**staged, "invalid_documents": _rows(bad_obs)}


def stage_archives(spark: SparkSession, paths: DataFrame, warehouse: str, run: str) -> dict:
    """Trace archives -> members (headers walked once) -> documents (decoded once) -> positions and quarantine of the run."""
    path = f"{warehouse.rstrip('/')}/trace_members/run={run_tag(run)}"
    write_parquet(archives.list_members(spark, paths), path)
    members = spark.read.schema(archives.MEMBERS_SCHEMA).parquet(path)
    docs = archives.parse_documents(archives.read_members(members, archives.tasks_for(members)))
    return stage_documents(spark, docs, warehouse, run)


def stage_states(spark: SparkSession, snapshots: DataFrame, warehouse: str, run: str, loaded_at: str) -> dict:
    """State-vector snapshots (with source_file and error) -> flat states of the run, and documents with an error in quarantine."""
    wh, tag = warehouse.rstrip("/"), run_tag(run)
    path = f"{wh}/state_documents/run={tag}"
    write_parquet(snapshots, path)
    kept = spark.read.schema(snapshots.schema).parquet(path)
    bad_o, bad_obs = _observed(kept.filter(F.col("error").isNotNull()).select("source_file", "error"), "bad")
    bad_o.write.mode("overwrite").parquet(f"{wh}/quarantine/states/run={tag}")
    rows_o, rows_obs = _observed(flatten_states(kept.filter(F.col("error").isNull()), loaded_at), "states")
    write_parquet(rows_o, f"{wh}/states/run={tag}")
    return {"state_rows": _rows(rows_obs), "invalid_documents": _rows(bad_obs)}


def _values(df: DataFrame) -> set:
    """Distinct values of a frame's only column, as one aggregated row."""
    return {r[0] for r in df.agg(F.collect_set(F.struct(*df.columns))).first()[0]}


def _dates_of(spark: SparkSession, path: str) -> list:
    """The dates for which a date-partitioned table has files: from its folders, one per date."""
    return [dt.date.fromisoformat(d) for d in INC.partitions(spark, path, "event_date")]


def run_flights(spark: SparkSession, raw_flights: DataFrame, warehouse: str, loaded_at: str,
                calendar: tuple[str, str] | None = None, incremental: bool = True) -> dict:
    """flights -> staging -> airports, calendar -> fct_flights.

    Each run stages its rows in a folder of its own; staging again under the same stamp replaces them.  A committed
    version of the fact has a ledger of the staged runs it contains and the duration histogram of their rows.
    An incremental run merges every staged run that the ledger lacks, whichever stamp it bears and whether or
    not an earlier job died after staging it; the histogram grows by those rows, so the rank equals a full
    build's.  The fact is built from all staging in full mode, where none is committed, and where a run
    that the ledger has was staged anew.  The calendar spans the staged departures unless bounds are given.
    """
    staged = stage_flights(spark, raw_flights, warehouse, loaded_at)
    return {**staged, **build_flights(spark, warehouse, calendar, incremental)}


def stage_flights(spark: SparkSession, raw_flights: DataFrame, warehouse: str, loaded_at: str, run: str | None = None) -> dict:
    """Stage the rows of a run (named by its stamp unless ``run`` is given); staging it again replaces them."""
    staged = FL.stage_flights(raw_flights, loaded_at=loaded_at).withColumn("_attempt", F.lit(uuid.uuid4().hex))
    tag = run_tag(run or loaded_at)
    path = f"{warehouse.rstrip('/')}/flights_stg/run={tag}"
    rows = Measures(spark, warehouse).write("stg_flights", staged, lambda df: df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path),
                                            lambda: spark.read.parquet(path), [tag])
    return {"stg_rows": rows}


def pending_flights(spark: SparkSession, warehouse: str) -> bool:
    """Are there staged runs that the committed fact lacks?"""
    wh = warehouse.rstrip("/")
    if not INC.matches(spark, f"{wh}/flights_stg/run=*"):
        return False
    versions = INC.list_versions(spark, f"{wh}/fct_flights")
    if not versions:
        return True
    runs = spark.read.parquet(f"{wh}/flights_stg").select("run", "_attempt").distinct()
    ledger = spark.read.parquet(INC.version_path(f"{wh}/fct_flights_runs", versions[-1]))
    return not runs.join(ledger, ["run", "_attempt"], "left_anti").isEmpty()


def build_flights(spark: SparkSession, warehouse: str, calendar: tuple[str, str] | None = None, incremental: bool = True) -> dict:
    """Airports, calendar and the next version of the fact from what is staged."""
    wh = warehouse.rstrip("/")
    stg = spark.read.parquet(f"{wh}/flights_stg")
    runs = stg.select("run", "_attempt").distinct()
    measures = Measures(spark, wh)
    _write_whole(measures, "dim_airports", FL.build_dim_airports(stg))
    _write_whole(measures, "dim_date", FL.build_dim_date(spark, *calendar) if calendar else FL.calendar_for(stg))
    cal = spark.read.parquet(f"{wh}/dim_date")

    table, ledgers, histograms = (f"{wh}/{name}" for name in ("fct_flights", "fct_flights_runs", "fct_flights_durations"))
    versions = INC.list_versions(spark, table) if incremental else []
    ledger = spark.read.parquet(INC.version_path(ledgers, versions[-1])) if versions else None
    if ledger is None or not ledger.join(runs, ["run", "_attempt"], "left_anti").isEmpty():
        base, histogram = FL.build_flight_base(stg, cal), FL.duration_histogram(stg)
    else:
        pending = stg.join(ledger, ["run", "_attempt"], "left_anti")
        current = spark.read.parquet(INC.version_path(table, versions[-1]))
        base = FL.merge_flight_base(current, stg, pending, cal)
        histogram = FL.add_histograms(spark.read.parquet(INC.version_path(histograms, versions[-1])), FL.duration_histogram(pending))
    version = INC.next_version(spark, table)
    write_parquet(runs, INC.version_path(ledgers, version))
    write_parquet(histogram, INC.version_path(histograms, version))
    ranked = FL.with_duration_rank(base, spark.read.parquet(INC.version_path(histograms, version)))
    path = INC.version_path(table, version)
    measures.write("fct_flights", ranked, lambda df: INC.commit_version(spark, df, table, version), lambda: spark.read.parquet(path), [str(version)])
    measures.forget("fct_flights", [s for s in measures.read("fct_flights") if s != str(version)])
    return {"fct_path": path}


FLIGHTS_BY_DAY = "fct_flights_by_day"


def flights_by_day(spark: SparkSession, warehouse: str) -> ManifestTable:
    """The flights fact without its rank, by departure day."""
    schema = T.StructType([*FL.FLIGHT_BASE.fields, T.StructField("departure_day", T.DateType())])
    return ManifestTable(spark, f"{warehouse.rstrip('/')}/{FLIGHTS_BY_DAY}", schema, "departure_day")


def build_flights_by_day(spark: SparkSession, warehouse: str, calendar: tuple[str, str] | None = None, keep: int = 3) -> dict:
    """The next version of the flights fact as a manifest table: only departure days of runs not merged yet are written.

    A version consists of its manifest, the ledger of staged runs in it and the (airport, duration) histogram of their rows;
    the manifest names the two, so one rename commits all three.  The rank isn't stored: it is joined on read from the
    histogram, as one late flight changes ranks on all days.  A run that was staged anew makes all days anew.  The last ``keep`` versions stay.
    """
    wh = warehouse.rstrip("/")
    table, stg = flights_by_day(spark, wh), spark.read.parquet(f"{wh}/flights_stg")
    runs = stg.select("run", "_attempt").distinct()
    base = table.manifest()
    ledger = spark.read.parquet(f"{table.path}/{base['extra']['runs']}") if base else None
    whole = ledger is None or not ledger.join(runs, ["run", "_attempt"], "left_anti").isEmpty()
    pending = stg if whole else stg.join(ledger, ["run", "_attempt"], "left_anti")
    day = F.to_date("departure_time")
    days = None if whole else sorted(_values(pending.filter(day.isNotNull()).select(day.alias("day"))))  # days of the new runs
    if days == [] and runs.join(ledger, ["run", "_attempt"], "left_anti").isEmpty():
        return {"version": base["version"], "days": 0}
    cal = FL.build_dim_date(spark, *calendar) if calendar else FL.calendar_for(stg)
    again = stg if whole else stg.filter(day.isin(days) & (F.col("departure_time") >= F.lit(min(days))) & (F.col("departure_time") < F.date_add(F.lit(max(days)), 1))) if days else stg.filter("false")
    histogram = FL.duration_histogram(pending)
    if not whole:
        histogram = FL.add_histograms(spark.read.parquet(f"{table.path}/{base['extra']['durations']}"), histogram)
    tag = uuid.uuid4().hex[:12]
    extra = {"runs": f"runs/{tag}", "durations": f"durations/{tag}"}
    write_parquet(runs, f"{table.path}/{extra['runs']}")
    write_parquet(histogram, f"{table.path}/{extra['durations']}")
    rows = FL.build_flight_base(again, cal).withColumn("departure_day", day)
    version = table.commit(rows, None if whole else [str(d) for d in days], base, extra)
    table.vacuum(keep)
    kept = {x for v in table.versions() for x in table.manifest(v)["extra"].values()}
    for kind in ("runs", "durations"):
        INC.remove(spark, [f"{table.path}/{kind}/{n}" for n in INC.children(spark, f"{table.path}/{kind}") if f"{kind}/{n}" not in kept])
    return {"version": version, "days": len(table.manifest()["files"]) if whole else len(days)}


def read_flights_by_day(spark: SparkSession, warehouse: str, version: int | None = None) -> DataFrame:
    """The flights fact of a version, rank joined on."""
    table = flights_by_day(spark, warehouse)
    histogram = spark.read.parquet(f"{table.path}/{table.manifest(version)['extra']['durations']}")
    return FL.with_duration_rank(table.read(version), histogram)


def run_tag(ts: str) -> str:
    """Folder-safe run identifier; different stamps, to the last digit and offset, have different ones."""
    return "r" + "".join(c if c.isascii() and c.isalnum() else f"_{ord(c):x}_" for c in str(ts))


def run_quality(spark: SparkSession, warehouse: str) -> DataFrame:
    """The declared checks over the tables that are written so far (one summary row per check).

    Row-level checks were counted when the tables were written; a table is scanned for them only where a job died before it had
    counted, or where an earlier release wrote it.
    """
    wh = warehouse.rstrip("/")
    names = {model: table for table, model in MODELS.items()}
    versions = INC.list_versions(spark, f"{wh}/fct_flights")

    class _Tables:
        def __getitem__(self, model):
            if model == "fct_flights":
                return INC.read_latest(spark, f"{wh}/fct_flights")
            df = spark.read.parquet(f"{wh}/{names.get(model, model)}")
            return df.drop("run", "_attempt") if model == "stg_flights" else df

    written = {"fct_flights": bool(versions)}

    def has(model: str | None) -> bool:
        return model is None or written.setdefault(model, INC.exists(spark, f"{wh}/{names.get(model, model)}"))

    def scopes(model: str) -> list[str]:
        table = names.get(model, model)
        if model == "fct_flights":
            return [str(versions[-1])]
        return INC.partitions(spark, f"{wh}/{table}", "event_date") if table in DATED else INC.partitions(spark, f"{wh}/{table}", "run") if model == "stg_flights" else ["all"]

    checks = [c for kind in ("not_null", "unique", "relationships", "accepted_range", "accepted_values")
              for c in DQ.declared_checks(kind) if has(c.model) and has(c.to_model)]
    measures, known, open_checks = Measures(spark, wh), [], [c for c in checks if c.kind not in DQ.ROW_LEVEL]
    for model in dict.fromkeys(c.model for c in checks if c.kind in DQ.ROW_LEVEL):
        own = [c for c in checks if c.kind in DQ.ROW_LEVEL and c.model == model]
        found = measures.summary(own, model, scopes(model))
        if found is None:
            open_checks += own
        else:
            known += found
    out = spark.createDataFrame(known, "test string, model string, column_name string, failing_rows long")
    return out.unionByName(DQ.run_checks(open_checks, _Tables())) if open_checks else out
