"""Custom stateful sessions: running click sessions per user, closed by event-time timers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE = "starts array<long>, ends array<long>, counts array<long>, clicks array<long>, rev long"
OUTPUT = "user_id long, session_start long, session_end long, n_events long, clicks long, status string, rev long"
PARTIAL = "user_id long, first long, last long, n long, clicks long"


def combine_slots(events: DataFrame, user: str, at: str, click: str, gap_seconds: int) -> DataFrame:
    """Collapse events of one user within one slot, batch by batch, before the shuffle.

    Slots are as wide as the gap, so two events of a slot always share a session; a user with
    a large part of all events sends a few rows per batch instead of all of them.
    """
    slot = gap_seconds * 1_000_000

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if b.empty:
                continue
            g = b.groupby([b["user_id"], b["t"] // slot])
            out = g.agg(first=("t", "min"), last=("t", "max"), n=("t", "size"), clicks=("c", "sum")).reset_index(level=0)
            yield out[["user_id", "first", "last", "n", "clicks"]]

    rows = events.select(F.col(user).alias("user_id"), F.unix_micros(at).alias("t"), F.expr(click).cast("long").alias("c"))
    return rows.mapInPandas(combine, PARTIAL)


def merge_spans(spans: list[tuple], gap: int) -> list[tuple]:
    """Join (start, end, n, clicks) tuples whose distance is at most the gap."""
    out: list[tuple] = []
    for s in sorted(spans):
        if out and s[0] - out[-1][1] <= gap:
            p = out[-1]
            out[-1] = (p[0], max(p[1], s[1]), p[2] + s[2], p[3] + s[3])
        else:
            out.append(s)
    return out


class Sessions(StatefulProcessor):
    """Open sessions of one user; late events may extend or bridge them until the watermark passes."""

    def __init__(self, gap_seconds: int):
        self.gap = gap_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("open", STATE)

    def _load(self) -> tuple[list[tuple], int]:
        if not self.state.exists():
            return [], 0
        starts, ends, counts, clicks, rev = self.state.get()
        return list(zip(starts, ends, counts, clicks)), rev

    def _save(self, spans: list[tuple], rev: int) -> None:
        cols = [[int(s[i]) for s in spans] for i in range(4)]
        self.state.update((*cols, rev))
        if spans:
            self.handle.registerTimer((min(s[1] for s in spans) + self.gap) // 1000 + 1)

    def _rows(self, key, spans: list[tuple], status: str, rev: int) -> pd.DataFrame:
        return pd.DataFrame({
            "user_id": [key[0]] * len(spans), "session_start": [s[0] for s in spans], "session_end": [s[1] for s in spans],
            "n_events": [s[2] for s in spans], "clicks": [s[3] for s in spans], "status": [status] * len(spans), "rev": [rev] * len(spans)})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        spans, rev = self._load()
        for pdf in rows:  # arrives in bounded Arrow batches; only merged spans are kept
            spans = merge_spans([*spans, *pdf[["first", "last", "n", "clicks"]].itertuples(index=False, name=None)], self.gap)
        self._save(spans, rev + 1)
        yield self._rows(key, spans, "open", rev + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        spans, rev = self._load()
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        closed = [s for s in spans if s[1] + self.gap < mark]
        if closed:
            left = [s for s in spans if s[1] + self.gap >= mark]
            self._save(left, rev)
            yield self._rows(key, closed, "closed", rev)

    def close(self) -> None:
        pass


def stateful_sessions(events: DataFrame, user: str, at: str, click: str, gap_seconds: int) -> DataFrame:
    """Update rows of ``OUTPUT`` for a watermarked stream: open sessions at each change, closed ones once.

    Needs the RocksDB state store. Turn the rows into current sessions with :func:`current_sessions`.
    """
    partial = combine_slots(events, user, at, click, gap_seconds)
    timed = partial.withColumn("seen", F.timestamp_micros("last")).withWatermark("seen", "1 hour")
    return timed.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=Sessions(gap_seconds), outputStructType=OUTPUT, outputMode="Update", timeMode="EventTime")


def current_sessions(updates: DataFrame) -> DataFrame:
    """Closed sessions, plus each user's open ones as of their newest revision."""
    newest = updates.groupBy("user_id").agg(F.max("rev").alias("__top"))
    closed = updates.where("status = 'closed'").drop("rev").distinct()
    live = updates.where("status = 'open'").join(newest, "user_id").where("rev = __top").drop("rev", "__top").distinct()
    live = live.join(closed, ["user_id", "session_start"], "left_anti")
    return closed.unionByName(live)
