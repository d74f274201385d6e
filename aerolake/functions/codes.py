"""Code mappings, labels and keys shared by silver and gold models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source project's outputs.
ALTITUDE_BANDS = ("Unknown", "Low", "Mid", "Cruise")      # NULL, < 3000 ft, < 10000 ft, otherwise
LOW_CEILING_FT = 3000
MID_CEILING_FT = 10000
GROUND_STATUSES = ("AIRBORNE", "ON GROUND", "UNKNOWN")   # code 0, code 1, anything else
DAY_PERIODS = ("Night", "Morning", "Afternoon", "Evening")  # 0-5, 6-11, 12-17, 18-23
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"         # placeholder hashed for NULL fields
SURROGATE_SEP = "-"                                       # separator between hashed fields


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def altitude_band(alt) -> Column:
    alt = _c(alt)
    return (F.when(alt.isNull(), F.lit("Unknown"))
            .when(alt < LOW_CEILING_FT, F.lit("Low"))
            .when(alt < MID_CEILING_FT, F.lit("Mid"))
            .otherwise(F.lit("Cruise")))


def ground_flag(code) -> Column:
    code = _c(code)
    return F.when(code == 0, F.lit(False)).when(code == 1, F.lit(True)).otherwise(F.lit(None).cast("boolean"))


def ground_status(code) -> Column:
    code = _c(code)
    return F.when(code == 0, F.lit("AIRBORNE")).when(code == 1, F.lit("ON GROUND")).otherwise(F.lit("UNKNOWN"))


def hour_label(hour) -> Column:
    h = _c(hour)
    return (F.when(h == 0, F.lit("12 AM"))
            .when(h < 12, F.concat(h.cast("string"), F.lit(" AM")))
            .when(h == 12, F.lit("12 PM"))
            .otherwise(F.concat((h - 12).cast("string"), F.lit(" PM"))))


def day_period(hour) -> Column:
    h = _c(hour)
    return (F.when(h.between(6, 11), F.lit("Morning"))
            .when(h.between(12, 17), F.lit("Afternoon"))
            .when(h.between(18, 23), F.lit("Evening"))
            .otherwise(F.lit("Night")))


def surrogate_key(*cols) -> Column:
    """md5 of the fields cast to text, NULL replaced by a placeholder, joined by '-'."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    body = parts[0] if len(parts) == 1 else F.concat_ws(SURROGATE_SEP, *parts)
    return F.md5(body)


def position_key(icao, event_ts) -> Column:
    """sha256 hex of '<icao24>|<epoch seconds>'; NULL if either part is NULL."""
    return F.sha2(F.concat(_c(icao), F.lit("|"), _c(event_ts).cast("string")), 256)
