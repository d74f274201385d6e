"""Window-style operators written so that no single group or key lands whole in one task.

* ``rank_desc``: SQL RANK() from a (partition, value) histogram instead of sorting each
  partition; a hot partition contributes one row per distinct value.
* ``lag_across_buckets``: LAG per key computed inside (key, time bucket) windows, with the
  bucket boundaries patched from a per-bucket summary; a hot key is split by time.
* ``running_count_across_buckets``: prefix count of a flag with the same two-level scheme.
* ``share_of_total`` / ``running_share`` / ``day_over_day`` / ``rank_top_k``: operate on an
  already aggregated (bounded) frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolake.functions.numeric import pct, round_half_up
from aerolake.functions.time import boundary_minutes, hour_index


def rank_table_desc(df: DataFrame, partition_cols: list[str], value_col: str, out: str) -> DataFrame:
    """(partition_cols, value_col, out) with out = RANK() OVER (PARTITION BY partition_cols
    ORDER BY value_col DESC NULLS LAST), one row per distinct (partition, value).

    rank = 1 + number of rows of the partition with a strictly greater value.  The histogram is
    aggregated map-side and its running sum is a window over distinct values only, so a hot
    partition never sorts its raw rows in one task.
    """
    hist = df.groupBy(*partition_cols, value_col).agg(F.count(F.lit(1)).alias("n"))
    return rank_from_histogram(hist, partition_cols, value_col, out)


def rank_from_histogram(hist: DataFrame, partition_cols: list[str], value_col: str, out: str) -> DataFrame:
    """The same from a ready histogram: (partition_cols, value_col, n), one row per distinct pair."""
    ahead = Window.partitionBy(*partition_cols).orderBy(F.col(value_col).desc_nulls_last()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    return hist.select(*partition_cols, value_col,
                       (F.coalesce(F.sum("n").over(ahead), F.lit(0)) + 1).cast("long").alias(out))


def rank_desc(df: DataFrame, partition_cols: list[str], value_col: str, out: str) -> DataFrame:
    """Add RANK() OVER (PARTITION BY partition_cols ORDER BY value_col DESC NULLS LAST) to every
    row, joining the rank table back with NULL-safe keys (a NULL partition key is one group)."""
    keys = [*partition_cols, value_col]
    r = rank_table_desc(df, partition_cols, value_col, out).select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], out)
    cond = None
    for k in keys:
        e = df[k].eqNullSafe(r[f"_r_{k}"])
        cond = e if cond is None else cond & e
    return df.join(r, cond, "left").drop(*[f"_r_{k}" for k in keys])


def lag_across_buckets(df: DataFrame, key: str, ts: str, out: str, order_tiebreak: list | None = None,
                       bucket=None, bucket_col: str | None = None) -> DataFrame:
    """Add LAG(ts) OVER (PARTITION BY key ORDER BY ts) without a per-key window.

    Rows are windowed per (key, bucket), bucket = hour of ``ts`` by default; the first row of a
    bucket takes the last ``ts`` of the key's previous non-empty bucket from a small
    (key, bucket) summary.  The summary join reuses the window's hash partitioning.

    Bound: on positions de-duplicated by (aircraft, whole epoch second) an (aircraft, hour)
    bucket holds at most 3,600 rows, however many rows one aircraft has overall.

    ``key`` and ``ts`` must be non-NULL (true for silver positions).  The boundary join uses
    plain equality on purpose: a NULL-safe condition would change the join's partitioning
    expression and re-shuffle the large side.
    """
    bc = bucket_col or "_bucket"
    b = df if bucket_col else df.withColumn(bc, hour_index(ts) if bucket is None else bucket)
    order = [F.col(ts).asc(), *(order_tiebreak or [])]
    inner = b.withColumn("_lag_in", F.lag(ts).over(Window.partitionBy(key, bc).orderBy(*order)))
    last = b.groupBy(key, bc).agg(F.max(ts).alias("_last"))
    carry = last.select(
        F.col(key).alias("_k"), F.col(bc).alias("_b"),
        F.lag("_last").over(Window.partitionBy(key).orderBy(bc)).alias("_carry"))
    j = inner.join(carry, (inner[key] == carry["_k"]) & (inner[bc] == carry["_b"]), "left")
    j = j.withColumn(out, F.coalesce("_lag_in", "_carry")).drop("_lag_in", "_carry", "_k", "_b")
    return j if bucket_col else j.drop(bc)


def running_count_across_buckets(df: DataFrame, key: str, ts: str, flag: str, out: str,
                                 order_tiebreak: list | None = None, bucket=None,
                                 bucket_col: str | None = None) -> DataFrame:
    """Add SUM(flag) OVER (PARTITION BY key ORDER BY ts ROWS UNBOUNDED PRECEDING) as a
    bucket-local prefix sum plus the key's total of all earlier buckets.  Pass ``bucket_col``
    to reuse a bucket column (and the (key, bucket) partitioning) of an earlier step."""
    bc = bucket_col or "_bucket"
    b = df if bucket_col else df.withColumn(bc, hour_index(ts) if bucket is None else bucket)
    order = [F.col(ts).asc(), *(order_tiebreak or [])]
    inner = b.withColumn("_run_in", F.sum(F.col(flag).cast("long")).over(
        Window.partitionBy(key, bc).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    per_bucket = b.groupBy(key, bc).agg(F.sum(F.col(flag).cast("long")).alias("_n"))
    before = per_bucket.select(
        F.col(key).alias("_k"), F.col(bc).alias("_b"),
        F.coalesce(F.sum("_n").over(Window.partitionBy(key).orderBy(bc)
                                    .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    j = inner.join(before, (inner[key] == before["_k"]) & (inner[bc] == before["_b"]), "left")
    j = j.withColumn(out, (F.col("_run_in") + F.col("_offset")).cast("long")).drop("_run_in", "_offset", "_k", "_b")
    return j if bucket_col else j.drop(bc)


def detect_gaps(positions: DataFrame, key: str = "icao24", ts: str = "event_datetime",
                minutes: int = 30, hour_col: str | None = None) -> DataFrame:
    """Rows whose boundary-minute gap to the previous position of the same key exceeds
    ``minutes``: (key, ts, prev_event_time, minutes_since_last).  ``hour_col`` names a column with the hour index of
    ``ts``; where positions are bucketed by (key, hour_col), full rows aren't exchanged."""
    p = positions.select(key, ts, *([hour_col] if hour_col else []))
    lagged = lag_across_buckets(p, key, ts, "prev_event_time", bucket_col=hour_col)
    gap = boundary_minutes("prev_event_time", ts)
    return lagged.select(key, ts, "prev_event_time", gap.cast("long").alias("minutes_since_last")) \
        .filter(F.col("minutes_since_last") > minutes)


def session_fragments(positions: DataFrame, key: str, ts: str, minutes: int, hour_col: str | None = None) -> DataFrame:
    """Runs of positions within one (key, hour) bucket whose gaps don't exceed ``minutes``: first, last, n.

    Full rows are exchanged once, by (key, bucket), so a key with a third of all rows is spread over its hours; a run of an
    hour is one row from here on (with 30 minutes, two a bucket at most).  Where positions are bucketed by (key, hour_col), they aren't exchanged at all.
    """
    bucket = ["_k", "_bucket"]
    inside = Window.partitionBy(*bucket).orderBy("_t")
    p = positions.select(F.col(key).alias("_k"), F.col(ts).alias("_t"), (F.col(hour_col) if hour_col else hour_index(ts)).alias("_bucket"))
    new = F.lag("_t").over(inside)
    runs = p.withColumn("_new", (new.isNull() | (boundary_minutes(new, "_t") > minutes)).cast("int")) \
        .withColumn("_run", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*bucket, "_run").agg(F.min("_t").alias("first"), F.max("_t").alias("last"), F.count(F.lit(1)).alias("n")) \
        .select("_k", "first", "last", "n")


def sessions(positions: DataFrame, key: str = "icao24", ts: str = "event_datetime",
             minutes: int = 30, hour_col: str | None = None) -> DataFrame:
    """One row per flight session: a new session starts at the first position of a key and
    whenever the boundary-minute gap exceeds ``minutes``.  Fragments of hours are stitched: one whose first position follows
    the last one of the fragment before closely enough continues its session."""
    in_order = Window.partitionBy("_k").orderBy("first", "last")
    before = F.lag("last").over(in_order)
    stitched = session_fragments(positions, key, ts, minutes, hour_col) \
        .withColumn("_new", (before.isNull() | (boundary_minutes(before, "first") > minutes)).cast("int")) \
        .withColumn("session_no", F.sum("_new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))
    return stitched.groupBy(F.col("_k").alias(key), "session_no").agg(
        F.min("first").alias("session_start"),
        F.max("last").alias("session_end"),
        F.sum("n").alias("positions"),
    ).withColumn("duration_minutes", boundary_minutes("session_start", "session_end").cast("long"))


def share_of_total(agg: DataFrame, measure: str, out: str = "pct_of_total", scale: int = 2,
                   keep_total: str | None = None) -> DataFrame:
    """measure as a percentage of its column total, on an aggregated (bounded) frame.  The
    total is a one-row aggregate joined by broadcast, not an unpartitioned window.
    ``keep_total`` names a column that keeps the total for later steps."""
    total = agg.agg(F.sum(measure).alias("_total"))
    out_df = agg.crossJoin(F.broadcast(total)).withColumn(out, pct(measure, "_total", scale))
    return out_df.withColumnRenamed("_total", keep_total) if keep_total else out_df.drop("_total")


def running_share(agg: DataFrame, measure: str, out: str = "cumulative_pct", scale: int = 2,
                  total_col: str | None = None) -> DataFrame:
    """Running share ordered by measure DESC with the default RANGE frame (ties share a value).
    Meant for small aggregated frames (e.g. a handful of altitude bands).  ``total_col`` reuses a
    total already joined to the frame."""
    w = Window.orderBy(F.col(measure).desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    if total_col is not None:
        return agg.withColumn(out, pct(F.sum(measure).over(w), total_col, scale))
    total = agg.agg(F.sum(measure).alias("_total"))
    return agg.crossJoin(F.broadcast(total)) \
        .withColumn(out, pct(F.sum(measure).over(w), "_total", scale)).drop("_total")


def day_over_day(daily: DataFrame, date_col: str, measure: str, prev: str = "prev_day_rows",
                 change: str = "pct_change") -> DataFrame:
    """LAG over a daily series (one row per date) and the percent change, NULL when the previous
    value is missing or 0."""
    w = Window.orderBy(date_col)
    d = daily.withColumn(prev, F.lag(measure).over(w))
    return d.withColumn(change, round_half_up(
        F.lit(100.0) * (F.col(measure) - F.col(prev)) / F.nullif(F.col(prev), F.lit(0)), 2))


def rank_top_k(agg: DataFrame, measure: str, k: int, tiebreak: list[str], out: str = "rank") -> DataFrame:
    """Top k rows by measure with RANK() over the whole frame.  The limit runs first
    (TakeOrderedAndProject); rank over the k survivors equals rank over all rows because every
    row with a larger measure is among them."""
    top = agg.orderBy(F.col(measure).desc(), *[F.col(c).asc_nulls_last() for c in tiebreak]).limit(k)
    w = Window.orderBy(F.col(measure).desc())
    return top.withColumn(out, F.rank().over(w).cast("long"))


def slice_windows(df: DataFrame, ts_col: str, anchor: str, n: int, days_back: int = 1,
                  width_s: int = 7200, step_s: int = 86400) -> DataFrame:
    """Tag rows falling in n backfill windows [end_i - width, end_i), end_i = anchor - (days_back
    + i) * step, i = 0..n-1.  Windows are disjoint and evenly spaced, so membership is arithmetic
    on (anchor - ts): a filter, no range join.  The overall span is also stated as a plain range
    on ``ts`` so the scan can skip row groups / partitions outside it."""
    if width_s > step_s:
        raise ValueError("windows must not overlap (width_s <= step_s)")
    import datetime as _dt
    a = _dt.datetime.fromisoformat(anchor)
    lo = a - _dt.timedelta(seconds=(days_back + n - 1) * step_s + width_s)
    hi = a - _dt.timedelta(seconds=days_back * step_s)
    anchor_ts = F.lit(anchor).cast("timestamp_ntz")
    span = (F.col(ts_col) >= F.lit(lo.isoformat(sep=" ")).cast("timestamp_ntz")) & \
        (F.col(ts_col) < F.lit(hi.isoformat(sep=" ")).cast("timestamp_ntz"))
    delta = F.timestamp_diff("MICROSECOND", F.col(ts_col), anchor_ts)  # anchor - ts, in micros
    step, width = step_s * 1_000_000, width_s * 1_000_000
    # delta in ((days_back + i) * step, (days_back + i) * step + width]
    q = F.floor((delta - 1) / F.lit(step)).cast("long")
    idx = q - days_back
    inside = (delta > 0) & (idx >= 0) & (idx < n) & ((delta - q * step) <= width)
    end = F.timestamp_add("SECOND", -(F.lit(days_back) + idx) * step_s, anchor_ts)
    return (df.filter(span).withColumn("_idx", idx).filter(inside)
            .withColumn("window_no", F.col("_idx").cast("int"))
            .withColumn("window_end", end)
            .withColumn("window_begin", F.timestamp_add("SECOND", F.lit(-width_s), F.col("window_end")))
            .drop("_idx"))


def pick_days_back(seed: int, lo: int = 1, hi: int = 60) -> int:
    """Start offset (days back) for a backfill run, drawn reproducibly from ``seed`` on the
    driver; pass it to ``slice_windows`` so a checked query never depends on ``rand()``."""
    import random
    return random.Random(seed).randint(lo, hi)
