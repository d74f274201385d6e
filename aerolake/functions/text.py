"""String clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upper_trim(x) -> Column:
    return F.upper(F.trim(_c(x)))


def blank_to_null(x) -> Column:
    """NULLIF(TRIM(x), '')."""
    return F.nullif(F.trim(_c(x)), F.lit(""))


def strip_ws(x) -> Column:
    """Strip all leading/trailing whitespace (tabs and newlines too), like Python's str.strip."""
    return F.regexp_replace(_c(x), r"^\s+|\s+$", "")
