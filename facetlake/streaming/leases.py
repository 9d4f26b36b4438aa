"""Leases that run out, in a stream: a timer for each job, and the same jobs as a table would give."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from facetlake.functions.constants import IN_FLIGHT_STATES
from facetlake.operators import jobs

REAPED = "job_id long, event_id long, state string, attempt int, lease_expires_at long, next_state string"
_EVENT = "at long, event_id long, state string, attempt int"


def _due(at: int, lease: int) -> int:
    """The watermark, in milliseconds, from which on a lease that began at these microseconds is over for good."""
    return (at + lease) // 1000 + 1


class Leases(StatefulProcessor):
    """Keeps a job's events until the watermark has passed the end of their leases: no event can then come in between.

    One timer a job, at its earliest lease's end. Each time it fires all leases that are over are settled in the order of time: one
    that no later event of the job renewed in time is reaped. Settled events leave the state, so it holds what a lease and the allowed
    delay hold; late events beyond the watermark change nothing that was settled.
    """

    def __init__(self, lease: int, max_attempts: int):
        self.lease, self.max_attempts = lease, max_attempts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", _EVENT)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        held = sorted(tuple(e) for e in self.events.get())
        before, wall = (held[0][0] if held else None), timerValues.getCurrentWatermarkInMs()
        for pdf in rows:
            fresh = zip(pdf["micros"].tolist(), pdf["event_id"].tolist(), pdf["state"].tolist(), pdf["attempt"].tolist())
            held += [e for e in fresh if e[0] // 1000 >= wall]
        held.sort()
        if held:
            self.events.put(held)
            if before != held[0][0]:
                if before is not None:
                    self.handle.deleteTimer(_due(before, self.lease))
                self.handle.registerTimer(_due(held[0][0], self.lease))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        held, wall = sorted(tuple(e) for e in self.events.get()), timerValues.getCurrentWatermarkInMs()
        out, n = [], 0
        while n < len(held) and _due(held[n][0], self.lease) <= wall:
            at, event, state, attempt = held[n]
            n += 1
            renewed = n < len(held) and held[n][0] <= at + self.lease
            if state in IN_FLIGHT_STATES and not renewed:
                out.append((key[0], event, state, attempt, at + self.lease, "queued" if attempt < self.max_attempts else "failed_terminal"))
        if n < len(held):
            self.events.put(held[n:])
            self.handle.registerTimer(_due(held[n][0], self.lease))
        else:
            self.events.clear()
        yield pd.DataFrame(out, columns=[f.split()[0] for f in REAPED.split(", ")]) if out else pd.DataFrame()

    def close(self) -> None:
        pass


def reaped(events: DataFrame, lease_seconds: int = 3600, late: str = "1 day", max_attempts: int = 3) -> DataFrame:
    """Rows of REAPED as leases run out, from a stream of (job_id, event_id, at timestamp, state, attempt)."""
    keyed = events.withColumn("micros", F.unix_micros("at")).withWatermark("at", late)
    return keyed.groupBy("job_id").transformWithStateInPandas(Leases(lease_seconds * 1_000_000, max_attempts), outputStructType=REAPED, outputMode="Append", timeMode="EventTime")


def reaped_by(events: DataFrame, watermark_ms: Column, lease_seconds: int = 3600, max_attempts: int = 3) -> DataFrame:
    """The same rows from a table: the batch reaper over the leases that no later event of their job renewed, as of a watermark."""
    lease = lease_seconds * 1_000_000
    after = F.lead("micros").over(Window.partitionBy("job_id").orderBy("micros", "event_id"))
    held = events.withColumn("micros", F.unix_micros("at")).withColumn("after", after).where(F.col("after").isNull() | (F.col("after") > F.col("micros") + lease))
    over = F.floor((F.col("micros") + lease) / 1000) + 1 <= watermark_ms
    rows = held.where(over).withColumn("lease_expires_at", F.col("micros") + lease)
    return jobs.reap(rows, F.lit((1 << 63) - 1), max_attempts).select(*[f.split()[0] for f in REAPED.split(", ")])
