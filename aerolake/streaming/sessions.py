"""Flight sessions of a stream with the batch ``sessions`` query's meaning.

A session ends where the gap to the next position crosses more than ``minutes`` minute boundaries, and of the copies of an
(aircraft, second) key the earliest counts.  Both need event-time order, so each aircraft keeps the positions that the
watermark hasn't passed yet, its open session, and the keys of the last ``copies`` seconds; an event-time timer
closes the session of an aircraft that falls silent.

Defined results: rows that fail the batch validity filter are dropped; rows later than the watermark are dropped by Spark;
positions without ``event_timestamp`` share one key per aircraft, as in the batch query; a copy whose time lies more than ``copies``
seconds after the first one's counts anew.  A session appears once, when the watermark proves it closed.
State per aircraft is 16 bytes a position within the watermark's delay; a trigger's rows of one aircraft are handled by one
task, so triggers should be bounded by files or offsets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from aerolake.functions.time import EPOCH, boundary_minutes
from aerolake.operators import positions as P
from aerolake.streaming.live import _event_time

STATE = "keys binary, times binary, seen_keys binary, seen_times binary, blank boolean, first long, last long, n long"
CLOSED = "icao24 string, first long, last long, n long"


def closed_sessions(minutes: int, copies: int):
    """The function of one aircraft for ``applyInPandasWithState``; times are microseconds since 1970."""
    minute, no_key = 60_000_000, -2 ** 63

    def close_at(last: int) -> int:
        """Positions from here on are in another session."""
        return (last // minute + minutes + 1) * minute

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        empty = (b"", b"", b"", b"", False, 0, 0, 0)
        *arrays, blank, first, last, n = state.get if state.exists else empty
        keys, times, seen_keys, seen_times = (np.frombuffer(x, np.int64) for x in arrays)
        if not state.hasTimedOut:
            new = [(f["second"].fillna(no_key).astype("int64").to_numpy(), f["micros"].to_numpy(np.int64)) for f in frames]
            keys, times = (np.concatenate([old, *(x[i] for x in new)]) for i, old in enumerate((keys, times)))
        order = np.lexsort((times, keys))
        keys, times = keys[order], times[order]
        own = np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)] & ~np.isin(keys, seen_keys)
        if blank:
            own &= keys != no_key
        keys, times = keys[own], times[own]

        passed = state.getCurrentWatermarkMs() * 1000
        ready = times <= passed
        done = np.sort(times[ready])
        closed = []
        if len(done):
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(done // minute) > minutes) + 1, [len(done)]])
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if n and done[lo] < close_at(last):
                    last, n = int(done[hi - 1]), n + hi - lo
                    continue
                if n:
                    closed.append((first, last, n))
                first, last, n = int(done[lo]), int(done[hi - 1]), hi - lo
        if n and close_at(last) <= passed:
            closed.append((first, last, n))
            first = last = n = 0
        blank = bool(blank or (keys[ready] == no_key).any())
        seen_keys, seen_times = np.concatenate([seen_keys, keys[ready]]), np.concatenate([seen_times, times[ready]])
        recent = (seen_times + copies * 1_000_000 > passed) & (seen_keys != no_key)
        seen_keys, seen_times, keys, times = seen_keys[recent], seen_times[recent], keys[~ready], times[~ready]

        wake = [close_at(last)] if n else [int(times.min())] if len(times) else [int(seen_times.max()) + copies * 1_000_000] if len(seen_times) else []
        if wake or blank:
            state.update((keys.tobytes(), times.tobytes(), seen_keys.tobytes(), seen_times.tobytes(), blank, int(first), int(last), int(n)))
            if wake:
                state.setTimeoutTimestamp(max(wake[0] // 1000 + 1, passed // 1000 + 1))
        elif state.exists:
            state.remove()
        if closed:
            yield pd.DataFrame([(key[0], *c) for c in closed], columns=["icao24", "first", "last", "n"])

    return run


def sessions_stream(raw: DataFrame, minutes: int = 30, delay: str = "1 hour", copies: int = 120) -> DataFrame:
    """Closed sessions of raw positions: the columns of the batch query but for the running number."""
    valid = _event_time(P.normalise_positions(raw)).withWatermark("_event_time", delay)
    narrow = valid.select("icao24", F.col("event_timestamp").alias("second"),
                          F.timestamp_diff("MICROSECOND", F.expr(EPOCH), F.col("event_datetime")).alias("micros"), "_event_time")
    closed = narrow.groupBy("icao24").applyInPandasWithState(closed_sessions(minutes, copies), CLOSED, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    at = {name: F.timestamp_add("MICROSECOND", F.col(name), F.expr(EPOCH)) for name in ("first", "last")}
    named = closed.select("icao24", at["first"].alias("session_start"), at["last"].alias("session_end"), F.col("n").alias("positions"))
    return named.withColumn("duration_minutes", boundary_minutes("session_start", "session_end").cast("long"))
