"""Tables of the catalog: declared schema, load by name, published layers, gaps and sessions over bucketed positions."""

import datetime as dt
import re
import uuid

import pytest

from aerolake.operators import windows as W
from aerolake.plans import jobs
from aerolake.plans.catalog import Models
from aerolake.sources import catalog
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL


@pytest.fixture()
def database(spark, tmp_path):
    name = "db_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_insert_by_name(spark, database):
    schema = T.StructType([T.StructField("callsign", T.StringType()), T.StructField("minutes", T.LongType()), T.StructField("day", T.DateType())])
    name = f"{database}.loads"
    catalog.create_table(spark, name, schema, ["day"])
    catalog.create_table(spark, name, schema, ["day"])  # there already
    catalog.insert_by_name(spark.createDataFrame([("2024-01-02", 7, "AB1", "x")], "DAY string, Minutes int, CALLSIGN string, extra string"), name)
    catalog.insert_by_name(spark.createDataFrame([(dt.date(2024, 1, 3), None)], "day date, callsign string"), name)
    catalog.insert_by_name(spark.createDataFrame([], "callsign string"), name)
    rows = {(r.callsign, r.minutes, r.day) for r in spark.table(name).collect()}
    assert rows == {("AB1", 7, dt.date(2024, 1, 2)), (None, None, dt.date(2024, 1, 3))}
    assert spark.table(name).columns == ["callsign", "minutes", "day"]


def _exchanged(df) -> list[str]:
    """Keys of the plan's hash exchanges."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


def test_gaps_and_sessions_over_bucketed_positions(spark, database):
    positions = Models(spark, SF_SMALL).stg_positions
    name = f"{database}.positions_by_hour"
    catalog.save_bucketed_positions(positions, name, 8)
    table = spark.table(name)
    assert table.count() == positions.count()
    for over, plain in ((W.detect_gaps(table, hour_col=catalog.HOUR), W.detect_gaps(positions)),
                        (W.sessions(table, hour_col=catalog.HOUR), W.sessions(positions))):
        assert sorted(map(tuple, over.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    # rows are windowed as they lie: only the summary of an aircraft's hours goes by aircraft, and comes back to its buckets
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fragments = W.session_fragments(table, "icao24", "event_datetime", 30, catalog.HOUR)
        assert _exchanged(fragments) == []
        gaps = _exchanged(W.detect_gaps(table, hour_col=catalog.HOUR))
        assert len(gaps) == 2
        assert len(_exchanged(W.detect_gaps(positions))) > len(gaps)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_published_layers(spark, tmp_path, database):
    wh = str(tmp_path / "wh")
    raw = Models(spark, SF_SMALL).positions_raw
    jobs.run_positions(spark, raw.filter(F.crc32(F.col("icao24").cast("binary")) % 2 == 0), wh, "2024-01-01 00:00:00")
    done = jobs.publish_tables(spark, wh, database, buckets=4)
    assert {"positions_silver", "fact_positions", "dim_aircraft", "agg_daily_traffic", "positions_by_hour"} <= set(done) and "fct_flights" not in done
    first = spark.table(f"{database}.fact_positions").count()
    assert first == spark.read.parquet(f"{wh}/fact_positions").count() > 0
    jobs.run_positions(spark, raw, wh, "2024-01-02 00:00:00")
    jobs.publish_tables(spark, wh, database, buckets=4)  # again: new dates and rows are there
    for name in ("fact_positions", "positions_silver", "dim_aircraft"):
        assert spark.table(f"{database}.{name}").count() == spark.read.parquet(f"{wh}/{name}").count()
    assert spark.table(f"{database}.positions_by_hour").count() == spark.table(f"{database}.positions_silver").count() > first
