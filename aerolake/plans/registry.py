"""Registry of named queries: Spark builder (over ``Models``) and DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from aerolake.operators import flights as FL
from aerolake.operators import profile as PR
from aerolake.operators import quality as DQ
from aerolake.plans import analyses as Q
from aerolake.operators import positions as P
from aerolake.operators import shaping as SH
from aerolake.operators import uniques as U
from aerolake.schemas import EVENTS
from aerolake.sources import files as FI
from aerolake.sources.sinks import shared_scratch, write_parquet, write_partitioned
from aerolake.sources.tables import table_path
from aerolake.plans.catalog import RUN_STAMP, Models
from aerolake.sources import fixtures as FX
from aerolake.plans.oracle import PCT, R, model, with_ctes


def _m(attr: str, drop: tuple[str, ...] = ()) -> Callable[[Models], DataFrame]:
    def build(m: Models) -> DataFrame:
        df = getattr(m, attr)
        return df.drop(*drop) if drop else df
    build.__name__ = attr
    return build


# name -> (spark builder, oracle SQL or None)
SPEC: dict[str, tuple[Callable[[Models], DataFrame], str | None]] = {}


def register(name: str, fn: Callable[[Models], DataFrame], sql: str | None):
    SPEC[name] = (fn, sql)


# ---- whole models ------------------------------------------------------------------------
for _name in ("clean_positions", "stg_positions", "fact_positions", "dim_aircraft", "dim_dates",
              "agg_daily_traffic", "agg_hourly_traffic", "agg_altitude_distribution", "agg_traffic_grid",
              "agg_aircraft_activity", "dim_airports"):
    register(_name, _m(_name), model(_name))
register("stg_flights", _m("stg_flights", ("_loaded_at",)), model("stg_flights", ("_loaded_at",)))
register("fct_flights", _m("fct_flights", ("_loaded_at",)), model("fct_flights", ("_loaded_at",)))
register("dim_date", _m("dim_date"), model("dim_date"))

# ---- flights analyses ---------------------------------------------------------------------
register("q02_01_count", Q.q02_01_count, with_ctes("SELECT COUNT(*) AS total_rows FROM flights_raw", "flights_raw"))
register("q02_02_snapshot_summary", Q.q02_02_snapshot_summary, """
    SELECT COUNT(*) AS total_rows, COUNT(DISTINCT icao24) AS unique_aircraft,
           COUNT(DISTINCT snapshot_time) AS snapshots, MIN(snapshot_time) AS first_snapshot,
           MAX(snapshot_time) AS last_snapshot
    FROM (SELECT user_id AS icao24, (epoch_us(ts) // 1000000) // 3600 * 3600 AS snapshot_time FROM events)""")
register("q02_03_sample", Q.q02_03_sample, with_ctes("""
    SELECT * EXCLUDE (_loaded_at) FROM stg_flights
    ORDER BY flight_callsign, aircraft_id, departure_time, arrival_time, departure_horiz_distance_m,
             arrival_horiz_distance_m
    LIMIT 10""", "stg_flights"))
register("q02_04_fct_count", Q.q02_04_fct_count, with_ctes("SELECT COUNT(*) AS total_rows FROM fct_flights", "fct_flights"))
register("q02_05_top_airports", Q.q02_05_top_airports, with_ctes("""
    SELECT airport_code, num_departures, avg_duration_min FROM airport_departures
    ORDER BY num_departures DESC, airport_code LIMIT 10""", "airport_departures"))
register("q02_06_flight_kpis", Q.q02_06_flight_kpis, with_ctes(f"""
    SELECT COUNT(*) AS total_flights, COUNT(DISTINCT aircraft_id) AS unique_aircraft,
           COUNT(DISTINCT departure_airport_key) AS departure_airports,
           COUNT(DISTINCT arrival_airport_key) AS arrival_airports,
           {R('AVG(flight_duration_minutes)', 2)} AS avg_duration_minutes,
           MAX(flight_duration_minutes) AS max_duration_minutes
    FROM fct_flights""", "fct_flights"))
register("q02_07_time_range", Q.q02_07_time_range, with_ctes(
    "SELECT MIN(departure_time) AS first_flight, MAX(departure_time) AS last_flight FROM fct_flights", "fct_flights"))
register("q02_08_key_coverage", Q.q02_08_key_coverage, with_ctes("""
    SELECT COUNT(*) AS total_rows, COUNT(departure_airport_key) AS flights_with_departure,
           COUNT(arrival_airport_key) AS flights_with_arrival, COUNT(departure_date_key) AS flights_with_date
    FROM fct_flights""", "fct_flights"))
register("q02_09_missing_keys", Q.q02_09_missing_keys, with_ctes("""
    SELECT COUNT(*) AS total_rows,
           COUNT(*) FILTER (WHERE departure_airport_key IS NULL) AS missing_departure_key,
           COUNT(*) FILTER (WHERE arrival_airport_key IS NULL) AS missing_arrival_key
    FROM fct_flights""", "fct_flights"))
register("q02_10_missing_airports", Q.q02_10_missing_airports, with_ctes("""
    SELECT COUNT(*) AS total_rows,
           COUNT(*) FILTER (WHERE departure_airport IS NULL) AS missing_departure_airport,
           COUNT(*) FILTER (WHERE arrival_airport IS NULL) AS missing_arrival_airport
    FROM stg_flights""", "stg_flights"))
register("q05_7_airport_rank", Q.q05_7_airport_rank, with_ctes(f"""
    SELECT airport_code, num_departures, rank() OVER (ORDER BY num_departures DESC) AS rank,
           {PCT('num_departures', 'SUM(num_departures) OVER ()')} AS pct_of_total
    FROM airport_departures
    ORDER BY num_departures DESC, airport_code LIMIT 10""", "airport_departures"))

# ---- positions: bronze -----------------------------------------------------------------------
_C = "clean_positions"
register("q03_01_count", Q.q03_01_count, with_ctes(f"SELECT COUNT(*) AS total_rows FROM {_C}", _C))
register("q04_01_sample", Q.q04_01_sample, with_ctes(
    f"SELECT * FROM {_C} ORDER BY icao24, event_timestamp LIMIT 10", _C))
register("q04_02_event_range", Q.q04_02_event_range, with_ctes(
    f"SELECT MIN(event_datetime) AS first_event, MAX(event_datetime) AS last_event FROM {_C}", _C))
register("q04_03_daily_rows", Q.q04_03_daily_rows, with_ctes(f"""
    SELECT CAST(event_datetime AS DATE) AS event_date, COUNT(*) AS total_rows FROM {_C}
    GROUP BY CAST(event_datetime AS DATE) ORDER BY event_date""", _C))
register("q04_04_aircraft", Q.q04_04_aircraft, with_ctes(
    f"SELECT COUNT(DISTINCT icao24) AS unique_aircraft FROM {_C}", _C))
register("q04_05_nulls", Q.q04_05_nulls, with_ctes(f"""
    SELECT COUNT(*) AS total_rows,
           COUNT(*) FILTER (WHERE icao24 IS NULL) AS null_icao24,
           COUNT(*) FILTER (WHERE event_datetime IS NULL) AS null_event_datetime,
           COUNT(*) FILTER (WHERE latitude IS NULL) AS null_latitude,
           COUNT(*) FILTER (WHERE longitude IS NULL) AS null_longitude,
           COUNT(*) FILTER (WHERE altitude_ft IS NULL) AS null_altitude
    FROM {_C}""", _C))
register("q04_06_geo_extent", Q.q04_06_geo_extent, with_ctes(f"""
    SELECT MIN(latitude) AS min_lat, MAX(latitude) AS max_lat, MIN(longitude) AS min_lon, MAX(longitude) AS max_lon
    FROM {_C}""", _C))
register("q04_07_ground", Q.q04_07_ground, with_ctes(
    f"SELECT on_ground, COUNT(*) AS total_rows FROM {_C} GROUP BY on_ground ORDER BY on_ground", _C))
register("q04_08_bands", Q.q04_08_bands, with_ctes(
    f"SELECT altitude_band, COUNT(*) AS total_rows FROM {_C} GROUP BY altitude_band ORDER BY altitude_band", _C))
register("q04_09_altitude_stats", Q.q04_09_altitude_stats, with_ctes(f"""
    SELECT MIN(altitude_ft) AS min_altitude, MAX(altitude_ft) AS max_altitude, AVG(altitude_ft) AS avg_altitude
    FROM {_C} WHERE altitude_ft IS NOT NULL""", _C))
register("q04_10_ground_extent", Q.q04_10_ground_extent, with_ctes(f"""
    SELECT on_ground, COUNT(*) AS total_rows, MIN(latitude) AS min_lat, MAX(latitude) AS max_lat,
           MIN(longitude) AS min_lon, MAX(longitude) AS max_lon
    FROM {_C} GROUP BY on_ground ORDER BY on_ground""", _C))
register("q04_11_unexpected_ground", Q.q04_11_unexpected_ground, with_ctes(f"""
    SELECT icao24, registration, callsign, on_ground, latitude, longitude, altitude_ft, event_datetime
    FROM {_C} WHERE on_ground IN (2, 3) ORDER BY icao24, event_timestamp LIMIT 30""", _C))

# ---- positions: silver QA --------------------------------------------------------------------
_S = "stg_positions"
register("q04_12_silver_summary", Q.q04_12_silver_summary, with_ctes(f"""
    SELECT COUNT(*) AS total_rows, COUNT(DISTINCT icao24) AS unique_aircraft, COUNT(DISTINCT event_date) AS days,
           COUNT(*) FILTER (WHERE icao24 IS NULL) AS null_icao24,
           COUNT(*) FILTER (WHERE event_datetime IS NULL) AS null_event_datetime,
           COUNT(*) FILTER (WHERE latitude IS NULL) AS null_latitude,
           COUNT(*) FILTER (WHERE longitude IS NULL) AS null_longitude,
           COUNT(*) FILTER (WHERE registration IS NULL) AS null_registration,
           COUNT(*) FILTER (WHERE callsign IS NULL) AS null_callsign,
           COUNT(*) FILTER (WHERE squawk IS NULL) AS null_squawk,
           MIN(latitude) AS min_latitude, MAX(latitude) AS max_latitude,
           MIN(longitude) AS min_longitude, MAX(longitude) AS max_longitude,
           MIN(event_datetime) AS first_event, MAX(event_datetime) AS last_event
    FROM {_S}""", _S))
register("q04_13_wrong_date", Q.q04_13_wrong_date, with_ctes(
    f"SELECT COUNT(*) AS wrong_event_date FROM {_S} WHERE event_date <> CAST(event_datetime AS DATE)", _S))
register("q04_14_lowercase", Q.q04_14_lowercase, with_ctes(
    f"SELECT COUNT(*) AS lowercase_icao24 FROM {_S} WHERE icao24 <> upper(icao24)", _S))
register("q04_15_spaces", Q.q04_15_spaces, with_ctes(
    f"SELECT COUNT(*) AS icao24_with_spaces FROM {_S} WHERE icao24 <> trim(icao24)", _S))
register("q04_16_bad_key", Q.q04_16_bad_key, with_ctes(
    f"SELECT COUNT(*) AS bad_icao24 FROM {_S} WHERE icao24 <> upper(trim(icao24))", _S))
register("q04_17_ground_mapping", Q.q04_17_ground_mapping, with_ctes(f"""
    SELECT on_ground, on_ground_flag, on_ground_status, COUNT(*) AS total_rows FROM {_S}
    GROUP BY on_ground, on_ground_flag, on_ground_status ORDER BY on_ground""", _S))
register("q04_18_band_summary", Q.q04_18_band_summary, with_ctes(f"""
    SELECT altitude_band, COUNT(*) AS total_rows, MIN(altitude_ft) AS min_altitude, MAX(altitude_ft) AS max_altitude
    FROM {_S} GROUP BY altitude_band ORDER BY altitude_band""", _S))
register("q04_19_duplicates", Q.q04_19_duplicates, with_ctes(f"""
    SELECT icao24, event_timestamp, COUNT(*) AS duplicate_count FROM {_S}
    GROUP BY icao24, event_timestamp HAVING COUNT(*) > 1
    ORDER BY duplicate_count DESC, icao24, event_timestamp LIMIT 20""", _S))
register("q04_20_orphan_dates", Q.q04_20_orphan_dates, with_ctes("""
    SELECT date_key, COUNT(*) AS rows_count FROM fact_positions f
    WHERE NOT EXISTS (FROM dim_dates d WHERE d.date_key = f.date_key) GROUP BY date_key""", "fact_positions", "dim_dates"))

# ---- advanced analytics ----------------------------------------------------------------------
register("q05_1_most_active", Q.q05_1_most_active, with_ctes(f"""
    SELECT rank() OVER (ORDER BY COUNT(*) DESC) AS rank, icao24, MIN(registration) AS registration,
           MIN(callsign) AS callsign, COUNT(*) AS total_positions, {R('AVG(altitude_ft)', 0)} AS avg_altitude_ft
    FROM {_S} GROUP BY icao24 ORDER BY total_positions DESC, icao24 LIMIT 15""", _S))
register("q05_2_hourly_share", Q.q05_2_hourly_share, with_ctes(f"""
    SELECT event_hour, COUNT(*) AS total_positions, {PCT('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS pct_of_total
    FROM {_S} GROUP BY event_hour ORDER BY event_hour""", _S))
register("q05_3_day_over_day", Q.q05_3_day_over_day, with_ctes(f"""
    WITH days AS (SELECT event_date AS d, COUNT(*) AS n FROM {_S} GROUP BY event_date),
    earlier AS (SELECT a.d, MAX(b.d) AS p FROM days a JOIN days b ON b.d < a.d GROUP BY a.d)
    SELECT now.d AS event_date, now.n AS total_rows, past.n AS prev_day_rows, {PCT('now.n - past.n', 'past.n')} AS pct_change
    FROM days now LEFT JOIN earlier USING (d) LEFT JOIN days past ON past.d = earlier.p""", _S))
register("q05_4_band_pareto", Q.q05_4_band_pareto, with_ctes(f"""
    SELECT altitude_band, COUNT(*) AS total_rows, {PCT('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS pct_of_total,
           {PCT('SUM(COUNT(*)) OVER (ORDER BY COUNT(*) DESC)', 'SUM(COUNT(*)) OVER ()')} AS cumulative_pct
    FROM {_S} GROUP BY altitude_band ORDER BY total_rows DESC, altitude_band""", _S))
register("q05_5_peak_airborne", Q.q05_5_peak_airborne, with_ctes(f"""
    SELECT event_date, event_hour, COUNT(DISTINCT icao24) AS aircraft_in_air FROM {_S}
    WHERE on_ground_flag = FALSE GROUP BY event_date, event_hour
    ORDER BY aircraft_in_air DESC, event_date, event_hour LIMIT 10""", _S))
register("q05_6_gaps", Q.q05_6_gaps, with_ctes(f"""
    WITH moments AS (SELECT DISTINCT icao24, event_datetime AS t FROM {_S}),
    silences AS (SELECT a.icao24, a.t AS event_datetime, b.t AS prev_event_time, date_diff('minute', b.t, a.t) AS minutes_since_last
                 FROM moments a ASOF JOIN moments b ON b.icao24 = a.icao24 AND b.t < a.t)
    SELECT * FROM silences WHERE minutes_since_last > 30
    ORDER BY minutes_since_last DESC, icao24, event_datetime LIMIT 20""", _S))
register("sessions", Q.sessions, with_ctes(f"""
    WITH ordered AS (
      SELECT icao24, event_datetime,
             LAG(event_datetime) OVER (PARTITION BY icao24 ORDER BY event_datetime) AS prev
      FROM {_S}),
    flagged AS (
      SELECT *, CASE WHEN prev IS NULL OR date_diff('minute', prev, event_datetime) > 30 THEN 1 ELSE 0 END AS is_new
      FROM ordered),
    numbered AS (
      SELECT *, SUM(is_new) OVER (PARTITION BY icao24 ORDER BY event_datetime
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_no
      FROM flagged)
    SELECT icao24, CAST(session_no AS BIGINT) AS session_no, MIN(event_datetime) AS session_start,
           MAX(event_datetime) AS session_end, COUNT(*) AS positions,
           date_diff('minute', MIN(event_datetime), MAX(event_datetime)) AS duration_minutes
    FROM numbered GROUP BY icao24, session_no""", _S))
register("slice_windows", Q.slice_windows, """
    SELECT e.event_id, e.ts, e.user_id, e.event_type, w.window_no, w.window_end, w.window_begin
    FROM events e
    JOIN (SELECT CAST(i AS INTEGER) AS window_no,
                 TIMESTAMP '2024-01-31 00:00:00' - (1 + i) * INTERVAL 1 DAY AS window_end,
                 TIMESTAMP '2024-01-31 00:00:00' - (1 + i) * INTERVAL 1 DAY - INTERVAL 2 HOUR AS window_begin
          FROM range(5) t(i)) w
      ON e.ts >= w.window_begin AND e.ts < w.window_end""")


# ---- data quality ----------------------------------------------------------------------------
def _dq_sql(c: DQ.Check) -> tuple[str, list[str]]:
    head = f"SELECT '{c.kind}' AS test, '{c.model}' AS model, '{c.column}' AS column_name"
    if c.kind == "not_null":
        return f"{head}, COUNT(*) FILTER (WHERE {c.column} IS NULL) AS failing_rows FROM {c.model}", [c.model]
    if c.kind == "unique":
        return (f"{head}, COUNT(*) AS failing_rows FROM (SELECT {c.column} FROM {c.model} "
                f"WHERE {c.column} IS NOT NULL GROUP BY {c.column} HAVING COUNT(*) > 1)"), [c.model]
    if c.kind == "relationships":
        return (f"{head}, COUNT(*) AS failing_rows FROM {c.model} ch LEFT JOIN {c.to_model} p "
                f"ON ch.{c.column} = p.{c.to_column} WHERE ch.{c.column} IS NOT NULL AND p.{c.to_column} IS NULL"), \
            [c.model, c.to_model]
    if c.kind == "accepted_range":
        op = ">=" if c.inclusive else ">"
        return (f"{head}, COUNT(*) FILTER (WHERE {c.column} IS NOT NULL AND NOT ({c.column} {op} {c.min_value})) "
                f"AS failing_rows FROM {c.model}"), [c.model]
    if c.kind == "accepted_values":
        vals = ", ".join(f"'{v}'" for v in c.values)
        return (f"{head}, COUNT(*) FILTER (WHERE {c.column} IS NOT NULL AND {c.column} NOT IN ({vals})) "
                f"AS failing_rows FROM {c.model}"), [c.model]
    raise ValueError(c.kind)


def _dq(kind: str):
    checks = DQ.declared_checks(kind)

    def build(m: Models) -> DataFrame:
        return DQ.run_checks(checks, m.as_mapping())

    parts = [_dq_sql(c) for c in checks]
    needed = sorted({n for _, ns in parts for n in ns})
    return build, with_ctes("\nUNION ALL\n".join(p for p, _ in parts), *needed)


for _kind, _key in (("not_null", "dq_not_null"), ("unique", "dq_unique"), ("relationships", "dq_relationships"),
                    ("accepted_range", "dq_range"), ("accepted_values", "dq_accepted_values")):
    register(_key, *_dq(_kind))
register("dq_long_flights", lambda m: DQ.long_flights(m.flight_base), with_ctes(f"""
    SELECT aircraft_id, flight_callsign, flight_duration_minutes FROM fct_flights
    WHERE flight_duration_minutes > {DQ.LONG_FLIGHT_MINUTES}""", "fct_flights"))

# ---- profiles --------------------------------------------------------------------------------
_RAW_COLS = ["icao24", "registration", "aircraft_type", "description", "event_timestamp", "event_datetime",
             "latitude", "longitude", "altitude_ft", "on_ground", "callsign", "squawk", "source"]
_CLEAN_COLS = ["icao24", "registration", "aircraft_type", "description", "callsign", "squawk", "latitude",
               "longitude", "altitude_ft", "on_ground", "event_timestamp", "event_datetime", "event_date",
               "event_hour", "altitude_band", "source"]


def _profile_sql(model: str, cols: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST({i + 1} AS INTEGER) AS ordinal, COUNT(*) AS total_rows, "
        f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {model}" for i, c in enumerate(cols))


register("prof_nulls", lambda m: PR.profile(m.positions_raw),
         with_ctes(_profile_sql("positions_raw", _RAW_COLS), "positions_raw"))
register("prof_before_after", lambda m: PR.compare_profiles(m.positions_raw, m.clean_positions), with_ctes(f"""
    WITH b AS ({_profile_sql("positions_raw", _RAW_COLS)}),
         a AS ({_profile_sql("clean_positions", _CLEAN_COLS)})
    SELECT coalesce(b.column_name, a.column_name) AS column_name, b.total_rows AS rows_before,
           b.null_count AS nulls_before, a.total_rows AS rows_after, a.null_count AS nulls_after
    FROM b FULL OUTER JOIN a ON b.column_name = a.column_name""", "positions_raw", "clean_positions"))
register("prof_rowcounts", lambda m: PR.row_counts(raw_rows=m.positions_raw, clean_rows=m.clean_positions,
                                                   silver_rows=m.stg_positions, fact_rows=m.fact_positions),
         with_ctes("""
    SELECT (SELECT COUNT(*) FROM positions_raw) AS raw_rows, (SELECT COUNT(*) FROM clean_positions) AS clean_rows,
           (SELECT COUNT(*) FROM stg_positions) AS silver_rows, (SELECT COUNT(*) FROM fact_positions) AS fact_rows""",
                   "positions_raw", "clean_positions", "stg_positions", "fact_positions"))


# ---- ingest shaping over documents derived from events ----------------------------------------
def _shp_states(m: Models) -> DataFrame:
    ev = m.table("events", ["event_id", "ts", "user_id", "event_type", "value"])
    return SH.flatten_states(FX.states_from_events(ev), RUN_STAMP).drop("processed_at")


def _shp_trace(m: Models) -> DataFrame:
    ev = m.table("events", ["event_id", "ts", "user_id", "event_type", "value"])
    return SH.flatten_traces(SH.parse_trace_documents(FX.trace_docs_from_events(ev)))


register("shp_states", _shp_states, """
    SELECT DISTINCT
      'ab' || lpad(CAST(user_id AS VARCHAR), 4, '0') AS icao24,
      'CS' || CAST(event_id % 40 AS VARCHAR) AS callsign,
      'Country' || CAST(user_id % 5 AS VARCHAR) AS origin_country,
      CASE WHEN short THEN NULL ELSE secs END AS time_position,
      CASE WHEN short THEN NULL ELSE secs + 1 END AS last_contact,
      CASE WHEN short THEN NULL ELSE ((event_id * 53) % 37000) / 100 - 185.0 END AS longitude,
      CASE WHEN short THEN NULL ELSE ((event_id * 37) % 19000) / 100 - 95.0 END AS latitude,
      CASE WHEN short THEN NULL ELSE alt END AS baro_altitude,
      CASE WHEN short THEN NULL ELSE event_type = 'purchase' END AS on_ground,
      CASE WHEN short THEN NULL ELSE value END AS velocity,
      CASE WHEN short THEN NULL ELSE CAST(event_id % 360 AS DOUBLE) END AS true_track,
      CAST(NULL AS DOUBLE) AS vertical_rate,
      CAST(NULL AS VARCHAR) AS sensors,
      CASE WHEN short THEN NULL ELSE alt + 50.0 END AS geo_altitude,
      CASE WHEN short THEN NULL ELSE lpad(CAST(event_id % 7777 AS VARCHAR), 4, '0') END AS squawk,
      CASE WHEN short THEN NULL ELSE FALSE END AS spi,
      CASE WHEN short THEN NULL ELSE CAST(0 AS BIGINT) END AS position_source,
      secs AS snapshot_time
    FROM (SELECT *, epoch_us(ts) // 1000000 AS secs, event_id % 50 = 0 AS short,
                 CASE WHEN event_type = 'error' THEN NULL ELSE round(value * 100) END AS alt
          FROM events)
    WHERE event_id % 71 <> 0 AND event_id % 73 <> 0 AND event_id % 97 <> 0""")
register("shp_trace", _shp_trace, with_ctes("SELECT * FROM trace_raw", "trace_raw"))



def _clean_traces(m: Models) -> DataFrame:
    return P.clean_positions(_shp_trace(m))


register("clean_traces", _clean_traces, with_ctes("SELECT * FROM trace_clean", "trace_clean"))


def _src_positions_parquet(m: Models) -> DataFrame:
    return FI.read_parquet(m.spark, table_path(m.sf_dir, "events"), EVENTS)


register("src_positions_parquet", _src_positions_parquet,
         "SELECT event_id, ts, user_id, event_type, value, props FROM events")


def _src_positions_pruned(m: Models) -> DataFrame:
    """Weekend traffic over positions stored by date: the dates come from the joined dimension while the query runs."""
    folder = shared_scratch(m.spark)
    write_partitioned(m.clean_positions, f"{folder}/positions", ["event_date"])
    positions = FI.read_positions_parquet(m.spark, f"{folder}/positions")
    write_parquet(P.build_dim_dates(positions), f"{folder}/dim_dates")
    weekend = m.spark.read.parquet(f"{folder}/dim_dates").filter(F.col("day_of_week").isin(0, 6)).select("event_date", "day_name")
    return positions.join(weekend, "event_date").groupBy("event_date", "day_name").agg(
        F.count(F.lit(1)).alias("position_count"), F.count_distinct("icao24").alias("unique_aircraft"))


register("src_positions_pruned", _src_positions_pruned, with_ctes("""
    SELECT event_date, strftime(event_date, '%a') AS day_name, COUNT(*) AS position_count, COUNT(DISTINCT icao24) AS unique_aircraft
    FROM clean_positions WHERE isodow(event_date) >= 6 GROUP BY event_date""", "clean_positions"))
register("agg_unique_aircraft", lambda m: U.unique_aircraft(m.clean_positions, U.dense_numbers(m.clean_positions, "icao24")), with_ctes("""
    SELECT 'hour' AS period, event_date, event_hour, COUNT(DISTINCT icao24) AS unique_aircraft FROM clean_positions GROUP BY event_date, event_hour
    UNION ALL SELECT 'day', event_date, NULL, COUNT(DISTINCT icao24) FROM clean_positions GROUP BY event_date
    UNION ALL SELECT 'month', CAST(date_trunc('month', event_date) AS DATE), NULL, COUNT(DISTINCT icao24) FROM clean_positions GROUP BY ALL
    UNION ALL SELECT 'all', NULL, NULL, COUNT(DISTINCT icao24) FROM clean_positions HAVING COUNT(*) > 0""", "clean_positions"))


def _delivered(m: Models) -> tuple[DataFrame, DataFrame]:
    """Staged flights in two deliveries; the second also corrects airports and arrivals of the first."""
    stg = m.stg_flights
    number = F.substring("aircraft_id", 2, 20).cast("long")
    corrected = stg.filter(number % 5 == 0).withColumns({
        "arrival_time": F.expr("arrival_time + INTERVAL 90 MINUTES"), "departure_airport": F.col("arrival_airport"),
        "_loaded_at": F.expr("_loaded_at + INTERVAL 1 DAY")})
    return stg.filter(number % 3 != 0), stg.filter(number % 3 == 0).unionByName(corrected)


def _inc_fct_flights(m: Models) -> DataFrame:
    first, second = _delivered(m)
    base = FL.build_flight_base(first, m.flight_calendar)
    merged = FL.merge_flight_base(base, first.unionByName(second), second, m.flight_calendar)
    histogram = FL.add_histograms(FL.duration_histogram(first), FL.duration_histogram(second))
    return FL.with_duration_rank(merged, histogram)


register("inc_fct_flights", _inc_fct_flights, model("fct_inc"))
register("fct_flights_dim_join", lambda m: FL.build_fct_flights(m.stg_flights, m.flight_calendar, m.dim_airports).drop("_loaded_at"),
         model("fct_flights", ("_loaded_at",)))

# ---- checks over rows that cleaning has not made valid yet, so that they do find something ----
register("raw_duplicates", lambda m: P.normalise_positions(m.positions_raw).groupBy("icao24", "event_timestamp")
         .agg(F.count(F.lit(1)).alias("duplicate_count")).filter("duplicate_count > 1"), with_ctes("""
    SELECT icao24, event_timestamp, COUNT(*) AS duplicate_count FROM clean_typed
    GROUP BY icao24, event_timestamp HAVING COUNT(*) > 1""", "clean_typed"))
register("raw_key_format", lambda m: m.positions_raw.agg(
    F.count_if(F.col("icao24").isNull()).alias("missing"), F.count_if(F.col("icao24") != F.trim("icao24")).alias("with_spaces"),
    F.count_if(F.col("icao24") != F.upper("icao24")).alias("lowercase"),
    F.count_if(~(F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180))).alias("off_the_globe")), with_ctes("""
    SELECT COUNT(*) FILTER (WHERE icao24 IS NULL) AS missing, COUNT(*) FILTER (WHERE icao24 <> trim(icao24)) AS with_spaces,
           COUNT(*) FILTER (WHERE icao24 <> upper(icao24)) AS lowercase,
           COUNT(*) FILTER (WHERE abs(latitude) > 90 OR abs(longitude) > 180) AS off_the_globe
    FROM positions_raw""", "positions_raw"))


def _orphan_dates(m: Models) -> DataFrame:
    """Fact dates that a dimension of even days only lacks."""
    keys = m.fact_positions.groupBy("date_key").agg(F.count(F.lit(1)).alias("rows_count"))
    return keys.join(m.dim_dates.filter("date_key % 2 = 0").select("date_key"), "date_key", "left_anti")


register("orphan_dates", _orphan_dates, with_ctes("""
    SELECT date_key, COUNT(*) AS rows_count FROM fact_positions f
    WHERE NOT EXISTS (SELECT 1 FROM dim_dates d WHERE d.date_key = f.date_key AND d.date_key % 2 = 0)
    GROUP BY date_key""", "fact_positions", "dim_dates"))


class _NarrowParents:
    """The models, with every second airport and aircraft missing from the dimensions."""

    def __init__(self, m: Models):
        self.m = m

    def __getitem__(self, name: str) -> DataFrame:
        df = self.m.as_mapping()[name]
        key = {"dim_airports": "airport_key", "dim_aircraft": "aircraft_key"}.get(name)
        return df.filter(F.substring(key, 1, 1) < "8") if key else df


register("dq_orphans", lambda m: DQ.run_checks(DQ.declared_checks("relationships"), _NarrowParents(m)), with_ctes("""
    SELECT 'relationships' AS test, 'fct_flights' AS model, 'departure_airport_key' AS column_name,
           COUNT(*) FILTER (WHERE departure_airport_key >= '8') AS failing_rows FROM fct_flights
    UNION ALL SELECT 'relationships', 'fct_flights', 'arrival_airport_key', COUNT(*) FILTER (WHERE arrival_airport_key >= '8') FROM fct_flights
    UNION ALL SELECT 'relationships', 'fact_positions', 'aircraft_key', COUNT(*) FILTER (WHERE aircraft_key >= '8') FROM fact_positions
    UNION ALL SELECT 'relationships', 'fact_positions', 'date_key', 0""", "fct_flights", "fact_positions"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: fn(Models(spark, sf_dir))
    return {name: bind(fn) for name, (fn, _) in SPEC.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in SPEC.items() if sql is not None}
