"""Table-driven data-quality checks.  Each check has a failing-rows form (0 rows = pass) and a
summary form; ``run_checks`` evaluates many checks with as few passes as possible:

* row-level checks (not_null, accepted_range, accepted_values) of one model are folded into a
  single aggregate with one ``count_if`` per check, then unpivoted;
* ``unique`` is a partial+final aggregate on the key, counting keys seen more than once;
* ``relationships`` checks of one child are evaluated in one pass: the checked columns are
  unpivoted, reduced to distinct non-NULL keys with row counts, then anti-joined with the
  parents' keys, so the join sides are bounded by the number of keys, not rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    kind: str                      # not_null | unique | relationships | accepted_range | accepted_values
    model: str
    column: str
    to_model: str | None = None    # relationships
    to_column: str | None = None
    min_value: float | None = None  # accepted_range
    max_value: float | None = None
    inclusive: bool = True
    values: tuple = field(default_factory=tuple)  # accepted_values


def violates(c: Check) -> F.Column:
    """Predicate true on a failing row.  NULLs pass range and values checks."""
    col = F.col(c.column)
    if c.kind == "not_null":
        return col.isNull()
    if c.kind == "accepted_range":
        ok = F.lit(True)
        if c.min_value is not None:
            ok = ok & ((col >= c.min_value) if c.inclusive else (col > c.min_value))
        if c.max_value is not None:
            ok = ok & ((col <= c.max_value) if c.inclusive else (col < c.max_value))
        return col.isNotNull() & ~ok
    if c.kind == "accepted_values":
        return col.isNotNull() & ~col.isin(*c.values)
    raise ValueError(f"not a row-level check: {c.kind}")


ROW_LEVEL = ("not_null", "accepted_range", "accepted_values")


def label(c: Check) -> str:
    """Name of a check within its model."""
    return f"{c.kind} {c.column}"


def row_level_checks(model: str) -> list[Check]:
    """The declared row-level checks of a model."""
    return [c for kind in ROW_LEVEL for c in declared_checks(kind) if c.model == model]


def quarantined(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``df`` with a row for each check that a row fails: test, column_name and the row as JSON are added."""
    failed = F.array_compact(F.array(*[F.when(violates(c), F.struct(F.lit(c.kind).alias("test"), F.lit(c.column).alias("column_name"))) for c in checks]))
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("row")
    return df.select("*", whole, F.explode(failed).alias("_failed")).select(*df.columns, "row", "_failed.test", "_failed.column_name")


def failing_rows(c: Check, models: Mapping[str, DataFrame]) -> DataFrame:
    """The rows (or keys) that make one check fail."""
    df = models[c.model]
    if c.kind in ROW_LEVEL:
        return df.filter(violates(c))
    if c.kind == "unique":
        return df.filter(F.col(c.column).isNotNull()).groupBy(c.column).agg(F.count(F.lit(1)).alias("n_records")) \
            .filter(F.col("n_records") > 1)
    if c.kind == "relationships":
        parent = models[c.to_model].select(F.col(c.to_column).alias(c.column)).distinct()
        return df.filter(F.col(c.column).isNotNull()).join(parent, c.column, "left_anti")
    raise ValueError(c.kind)


SUMMARY_COLUMNS = ["test", "model", "column_name", "failing_rows"]


def _row_level_summary(model: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    aggs = [F.count_if(violates(c)).alias(f"_c{i}") for i, c in enumerate(checks)]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c.kind}', '{c.column}', _c{i}" for i, c in enumerate(checks))
    long = wide.selectExpr(f"stack({len(checks)}, {stack}) AS (test, column_name, failing_rows)")
    return long.select(F.col("test"), F.lit(model).alias("model"), "column_name",
                       F.col("failing_rows").cast("long").alias("failing_rows"))


def _unique_summary(c: Check, models: Mapping[str, DataFrame]) -> DataFrame:
    bad = failing_rows(c, models).agg(F.count(F.lit(1)).alias("failing_rows"))
    return bad.select(F.lit(c.kind).alias("test"), F.lit(c.model).alias("model"),
                      F.lit(c.column).alias("column_name"), F.col("failing_rows").cast("long"))


def _relationships_summary(model: str, checks: Sequence[Check], models: Mapping[str, DataFrame]) -> DataFrame:
    """All relationship checks of one child model in one pass over it: the checked columns are
    unpivoted to (column_name, key), counted per distinct key (partial aggregation), and
    anti-joined with the parents' distinct keys tagged by the same column name."""
    child = models[model]
    pairs = F.explode(F.array(*[F.struct(F.lit(c.column).alias("column_name"),
                                         F.col(c.column).cast("string").alias("key")) for c in checks]))
    keys = (child.select(pairs.alias("p")).select("p.column_name", "p.key")
            .filter(F.col("key").isNotNull()).groupBy("column_name", "key").agg(F.count(F.lit(1)).alias("_n")))
    parents = None
    for c in checks:
        pk = models[c.to_model].select(F.lit(c.column).alias("column_name"),
                                       F.col(c.to_column).cast("string").alias("key"))
        parents = pk if parents is None else parents.unionByName(pk)
    orphans = keys.join(parents.distinct(), ["column_name", "key"], "left_anti") \
        .groupBy("column_name").agg(F.sum("_n").alias("_bad"))
    names = child.sparkSession.createDataFrame([(c.column,) for c in checks], "column_name string")
    return names.join(orphans, "column_name", "left").select(
        F.lit("relationships").alias("test"), F.lit(model).alias("model"), "column_name",
        F.coalesce(F.col("_bad"), F.lit(0)).cast("long").alias("failing_rows"))


def run_checks(checks: Sequence[Check], models: Mapping[str, DataFrame]) -> DataFrame:
    """One summary row per check: (test, model, column_name, failing_rows)."""
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    rel_by_model: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind in ROW_LEVEL:
            by_model.setdefault(c.model, []).append(c)
        elif c.kind == "relationships":
            rel_by_model.setdefault(c.model, []).append(c)
        else:
            parts.append(_unique_summary(c, models))
    for model, cs in by_model.items():
        parts.append(_row_level_summary(model, models[model], cs))
    for model, cs in rel_by_model.items():
        parts.append(_relationships_summary(model, cs, models))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- the checks declared by the source project's model files ----------------------------------
NOT_NULL = {
    "clean_positions": ["icao24", "event_datetime", "latitude", "longitude"],
    "stg_flights": ["aircraft_id", "departure_time"],
    "dim_airports": ["airport_key"],
    "dim_date": ["date_key"],
    "stg_positions": ["icao24", "event_datetime", "latitude", "longitude", "event_date"],
    "dim_aircraft": ["aircraft_key", "icao24"],
    "dim_dates": ["date_key", "event_date"],
    "fact_positions": ["position_key", "aircraft_key", "date_key", "event_datetime", "latitude", "longitude"],
    "agg_daily_traffic": ["event_date", "position_count", "unique_aircraft", "date_key"],
    "agg_hourly_traffic": ["event_date", "time_key", "position_count", "date_key"],
    "agg_altitude_distribution": ["event_date", "altitude_band", "position_count", "date_key"],
    "agg_traffic_grid": ["event_date", "latitude_grid", "longitude_grid", "position_count", "date_key"],
    "dim_time": ["time_key", "hour_number", "hour_label", "day_period"],
    "agg_aircraft_activity": ["aircraft_key", "event_date", "date_key", "position_count"],
}
UNIQUE = [("dim_airports", "airport_key"), ("dim_date", "date_key"), ("dim_aircraft", "aircraft_key"),
          ("dim_dates", "date_key"), ("fact_positions", "position_key"), ("agg_daily_traffic", "event_date"),
          ("dim_time", "time_key")]
RELATIONSHIPS = [("fct_flights", "departure_airport_key", "dim_airports", "airport_key"),
                 ("fct_flights", "arrival_airport_key", "dim_airports", "airport_key"),
                 ("fact_positions", "aircraft_key", "dim_aircraft", "aircraft_key"),
                 ("fact_positions", "date_key", "dim_dates", "date_key")]
RANGES = [Check("accepted_range", "stg_flights", "departure_horiz_distance_m", min_value=0, inclusive=True),
          Check("accepted_range", "fct_flights", "flight_duration_minutes", min_value=0, inclusive=False)]
VALUES = [Check("accepted_values", "stg_positions", "on_ground_status",
                values=("AIRBORNE", "ON GROUND", "UNKNOWN"))]
LONG_FLIGHT_MINUTES = 1440


def declared_checks(kind: str) -> list[Check]:
    if kind == "not_null":
        return [Check("not_null", m, c) for m, cols in NOT_NULL.items() for c in cols]
    if kind == "unique":
        return [Check("unique", m, c) for m, c in UNIQUE]
    if kind == "relationships":
        return [Check("relationships", m, c, to_model=tm, to_column=tc) for m, c, tm, tc in RELATIONSHIPS]
    if kind == "accepted_range":
        return list(RANGES)
    if kind == "accepted_values":
        return list(VALUES)
    raise ValueError(kind)


def long_flights(fct: DataFrame, minutes: int = LONG_FLIGHT_MINUTES) -> DataFrame:
    """Singular test: flights longer than a day."""
    return fct.filter(F.col("flight_duration_minutes") > minutes) \
        .select("aircraft_id", "flight_callsign", "flight_duration_minutes")
