"""Zone-free time expressions on TIMESTAMP_NTZ columns.

``unix_timestamp`` of an NTZ value and ``timestampadd`` on an NTZ value are wall-clock
arithmetic (no session-zone conversion), so these results do not depend on
``spark.sql.session.timeZone``; all stay inside whole-stage codegen.  Indexes are for
timestamps from 1970 on (pre-1970 sub-second values truncate toward zero).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts) -> Column:
    """Whole epoch seconds of an NTZ timestamp (sub-second part truncated), BIGINT."""
    return F.unix_timestamp(_c(ts))


def from_epoch_seconds(secs) -> Column:
    """TIMESTAMP_NTZ wall clock at UTC for epoch seconds (the warehouse's to_timestamp_ntz)."""
    return F.timestamp_add("SECOND", _c(secs).cast("long"), F.expr(EPOCH))


def minute_index(ts) -> Column:
    """Number of minute boundaries since the epoch."""
    return F.floor(epoch_seconds(ts) / 60)


def hour_index(ts) -> Column:
    """Number of hour boundaries since the epoch (a time bucket for skew-safe windows)."""
    return F.floor(epoch_seconds(ts) / 3600)


def boundary_minutes(start, end) -> Column:
    """DATEDIFF('minute', start, end) of the warehouse: minute boundaries crossed, not elapsed
    minutes (00:00:59 -> 00:31:00 is 31)."""
    return minute_index(end) - minute_index(start)


def date_key(d) -> Column:
    """Integer YYYYMMDD key of a date, by arithmetic instead of string formatting."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_of_week_sun0(d) -> Column:
    """Day of week with Sunday = 0 .. Saturday = 6."""
    return (F.dayofweek(_c(d)) - 1).cast("int")


def utc_now_ntz() -> Column:
    """The run's current instant as a UTC wall-clock TIMESTAMP_NTZ (independent of the session
    zone, unlike casting current_timestamp())."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(F.current_timestamp()), F.expr(EPOCH))
