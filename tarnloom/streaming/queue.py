"""Streams: visited sets, leases and their reaper, limits, sessions and metering, on Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LEASE = "60 seconds"
MAX_STALLS = 9


def event_time(df: DataFrame, column: str = "ts", late: str = "24 hours") -> DataFrame:
    """A zoneless time as UTC, with a watermark."""
    return df.withColumn(column, F.to_timestamp(F.col(column).cast("string"))).withWatermark(column, late)


def visited_once(events: DataFrame, key: str, late: str = "24 hours", column: str = "ts") -> DataFrame:
    """The first event of each key within the watermark's time: insert-if-absent with expiry."""
    return event_time(events, column, late).dropDuplicatesWithinWatermark([key])


def sessions(events: DataFrame, key: str, gap: str, late: str = "24 hours", column: str = "ts") -> DataFrame:
    s = event_time(events, column, late).groupBy(key, F.session_window(column, gap).alias("w")).agg(F.count("*").alias("n"))
    return s.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def window_counts(events: DataFrame, key: str, size: str, late: str = "24 hours", column: str = "ts") -> DataFrame:
    c = event_time(events, column, late).groupBy(key, F.window(column, size).alias("w")).agg(F.count("*").alias("n"))
    return c.select(key, F.col("w.start").alias("start"), "n")


def running_frequency(events: DataFrame, key: str) -> DataFrame:
    """Counts per key so far (update mode)."""
    return events.groupBy(key).agg(F.count("*").alias("frequency"))


JOB_STATE = "status string, locked_at double, stalls int"
JOB_OUT = "job_id string, status string, stalls int, at double"


def apply_job_events(state: tuple[str, float, int] | None, events: list[tuple[str, float]], lease: float = 60.0, max_stalls: int = MAX_STALLS) -> tuple[tuple[str, float, int], float]:
    """State of one job (status, locked at, stalls) after its events (kind, time) in order, and the last time.

    add queues, take locks, renew extends, done and fail end; a lock older than the lease goes back to the queue with
    one more stall, or fails at the last. An ended job stays ended.
    """
    status, locked, stalls = state or ("queued", 0.0, 0)
    last = 0.0
    for kind, at in sorted(events, key=lambda e: (e[1], e[0])):
        last = at
        if status == "active" and at - locked > lease:
            status, stalls = ("failed", stalls) if stalls >= max_stalls else ("queued", stalls + 1)
        if status in ("completed", "failed"):
            continue
        if kind == "take" and status == "queued":
            status, locked = "active", at
        elif kind == "renew" and status == "active":
            locked = at
        elif kind == "done" and status == "active":
            status = "completed"
        elif kind == "fail" and status == "active":
            status = "failed"
    return (status, locked, stalls), last


def job_states(log: DataFrame, late: str = "1 hour") -> DataFrame:
    """A stream of (job_id, kind, ts) folded into each job's status; expired leases are reaped by the watermark."""

    def fold(key: Any, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.get if state.exists else None
        if state.hasTimedOut:
            status, locked, stalls = now
            at = state.getCurrentWatermarkMs() / 1000
            new, last = apply_job_events((status, locked, stalls), [("tick", max(at, locked + 61))])
        else:
            events = [(k, t.timestamp()) for b in batches for k, t in zip(b["kind"], b["ts"])]
            new, last = apply_job_events(now, events)
        if new[0] in ("completed", "failed"):
            state.remove()
        else:
            state.update(new)
            if new[0] == "active":
                state.setTimeoutTimestamp(max(int((new[1] + 60) * 1000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"job_id": [key[0]], "status": [new[0]], "stalls": [new[2]], "at": [last]})

    timed = event_time(log, "ts", late)
    return timed.groupBy("job_id").applyInPandasWithState(fold, JOB_OUT, JOB_STATE, "update", GroupStateTimeout.EventTimeTimeout)


def admitted(requests: DataFrame, points: int, seconds: float, late: str = "1 hour") -> DataFrame:
    """key, ts, allowed: at most `points` per key in a window that begins at the key's first request after the last one's end."""

    def fold(key: Any, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start, used = state.get if state.exists else (-1e18, 0)
        rows = pd.concat(list(batches)).sort_values("ts")
        out = []
        for t in rows["ts"]:
            at = t.timestamp()
            if at - start >= seconds:
                start, used = at, 0
            used += 1
            out.append((key[0], t, used <= points))
        state.update((start, used))
        yield pd.DataFrame(out, columns=["key", "ts", "allowed"])

    timed = event_time(requests, "ts", late)
    return timed.groupBy("key").applyInPandasWithState(fold, "key string, ts timestamp, allowed boolean", "start double, used int", "append", GroupStateTimeout.NoTimeout)


def live_leases(leases: DataFrame, now: str) -> DataFrame:
    """owner, active, waiting at a moment: leases (owner, kind, expires) that have not run out."""
    live = leases.where(F.col("expires") >= F.to_timestamp(F.lit(now)))
    return live.groupBy("owner").agg(F.count_if(F.col("kind") == "active").alias("active"), F.count_if(F.col("kind") == "waiting").alias("waiting"))
