"""Lazily built models over one table directory (the driver's ``sf_dir``).

Every attribute is a lazy DataFrame; nothing is collected.  In the production job the same
functions run over files (aerolake.sources) and write each layer once (aerolake.plans.jobs).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from aerolake.operators import aggregates as A
from aerolake.operators import flights as FL
from aerolake.operators import positions as P
from aerolake.sources.fixtures import flights_raw_from_orders, positions_raw_from_events
from aerolake.sources.tables import read_table

# Calendar joined to flight departures (FIXTURES.md B2): 1996-01-01 .. 2001-01-01 exclusive, so
# that departures outside it stay unmatched.
FLIGHT_CALENDAR = ("1996-01-01", "2001-01-01")
# The calendar model of the source project: every day of 2026.
CALENDAR_2026 = ("2026-01-01", "2027-01-01")
# Fixed run stamp for staged flights in checked queries (the job stamps the real run time).
RUN_STAMP = "2026-01-01 00:00:00"


class Models:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def as_mapping(self) -> "_ModelMap":
        """Models by name, built on first use (for table-driven checks)."""
        return _ModelMap(self)

    MODEL_NAMES = ("positions_raw", "clean_positions", "stg_positions", "fact_positions", "dim_aircraft",
                   "dim_dates", "dim_time", "agg_daily_traffic", "agg_hourly_traffic", "agg_altitude_distribution",
                   "agg_traffic_grid", "agg_aircraft_activity", "flights_raw", "stg_flights", "dim_airports",
                   "dim_date", "fct_flights")

    def register_views(self, names: tuple[str, ...] | None = None) -> list[str]:
        """Expose the models as temporary views for ``spark.sql`` (lazy: a view is a plan)."""
        out = []
        for n in names or self.MODEL_NAMES:
            getattr(self, n).createOrReplaceTempView(n)
            out.append(n)
        return out

    def table(self, name: str, columns: list[str] | None = None) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name, columns)

    # ---- Track 2: positions -------------------------------------------------------------
    @cached_property
    def positions_raw(self) -> DataFrame:
        return positions_raw_from_events(self.table("events", ["event_id", "ts", "user_id", "event_type", "value"]))

    @cached_property
    def clean_positions(self) -> DataFrame:
        return P.clean_positions(self.positions_raw)

    @cached_property
    def stg_positions(self) -> DataFrame:
        return P.standardise_positions(self.clean_positions)

    @cached_property
    def fact_positions(self) -> DataFrame:
        return P.build_fact(self.stg_positions)

    @cached_property
    def dim_aircraft(self) -> DataFrame:
        return P.build_dim_aircraft(self.stg_positions)

    @cached_property
    def dim_dates(self) -> DataFrame:
        return P.build_dim_dates(self.stg_positions)

    @cached_property
    def dim_time(self) -> DataFrame:
        return P.build_dim_time(self.spark)

    @cached_property
    def agg_daily_traffic(self) -> DataFrame:
        return A.agg_daily_traffic(self.fact_positions)

    @cached_property
    def agg_hourly_traffic(self) -> DataFrame:
        return A.agg_hourly_traffic(self.fact_positions)

    @cached_property
    def agg_altitude_distribution(self) -> DataFrame:
        return A.agg_altitude_distribution(self.fact_positions)

    @cached_property
    def agg_traffic_grid(self) -> DataFrame:
        return A.agg_traffic_grid(self.fact_positions)

    @cached_property
    def agg_aircraft_activity(self) -> DataFrame:
        return A.agg_aircraft_activity(self.fact_positions)

    # ---- Track 1: flights ---------------------------------------------------------------
    @cached_property
    def flights_raw(self) -> DataFrame:
        return flights_raw_from_orders(
            self.table("lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"]),
            self.table("orders", ["o_orderkey", "o_custkey", "o_orderdate"]),
            self.table("customer", ["c_custkey", "c_nationkey"]),
            self.table("supplier", ["s_suppkey", "s_nationkey"]),
        )

    @cached_property
    def stg_flights(self) -> DataFrame:
        return FL.stage_flights(self.flights_raw, loaded_at=RUN_STAMP)

    @cached_property
    def dim_airports(self) -> DataFrame:
        return FL.build_dim_airports(self.stg_flights)

    @cached_property
    def flight_calendar(self) -> DataFrame:
        return FL.build_dim_date(self.spark, *FLIGHT_CALENDAR)

    @cached_property
    def dim_date(self) -> DataFrame:
        """Calendar spanning the staged departures (data-derived bounds)."""
        return FL.calendar_for(self.stg_flights, "departure_time")

    @cached_property
    def fct_flights(self) -> DataFrame:
        return FL.with_duration_rank(self.flight_base, FL.duration_histogram(self.stg_flights))

    @cached_property
    def flight_base(self) -> DataFrame:
        """The fact without its rank, for queries that read none."""
        return FL.build_flight_base(self.stg_flights, self.flight_calendar)


class _ModelMap:
    def __init__(self, m: Models):
        self._m = m

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self._m, {"fct_flights": "flight_base"}.get(name, name))  # no declared check reads the rank
