"""Column expressions (pure, JVM-side)."""

from aerolake.functions.codes import (altitude_band, day_period, ground_flag, ground_status, hour_label,
                                      position_key, surrogate_key)
from aerolake.functions.numeric import pct, round_half_up
from aerolake.functions.text import blank_to_null, strip_ws, upper_trim
from aerolake.functions.time import (boundary_minutes, date_key, day_of_week_sun0, epoch_seconds,
                                     from_epoch_seconds, hour_index, minute_index)

__all__ = [
    "altitude_band", "day_period", "ground_flag", "ground_status", "hour_label", "position_key",
    "surrogate_key", "pct", "round_half_up", "blank_to_null", "strip_ws", "upper_trim",
    "boundary_minutes", "date_key", "day_of_week_sun0", "epoch_seconds", "from_epoch_seconds",
    "hour_index", "minute_index",
]
