"""Numeric helpers that give the same answer in Spark and in the oracle engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(x, scale: int = 0) -> Column:
    """ROUND(x, scale) half away from zero on the decimal value, returned as DOUBLE.

    Rounding a binary double directly differs between engines (1.005 -> 1.01 or 1.0); going
    through DECIMAL(38, 12) first fixes the digits both engines see.
    """
    return F.round(_c(x).cast("decimal(38,12)"), scale).cast("double")


def pct(part, whole, scale: int = 2) -> Column:
    """round(100 * part / nullif(whole, 0), scale) as DOUBLE; NULL when whole is 0 or NULL."""
    return round_half_up(F.lit(100.0) * _c(part) / F.nullif(_c(whole), F.lit(0)), scale)
