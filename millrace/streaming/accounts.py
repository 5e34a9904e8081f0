"""What streaming queries report about themselves, as rows: input, late rows, state, durations, restarts."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SHAPE = "query string, run string, batch long, at string, rows_in long, late long, state_rows long, state_bytes long, trigger_ms long, watermark string"


class Accounts(StreamingQueryListener):
    """Collects one row per micro-batch of the queries it follows. Reports hold totals only, so they stay small."""

    def __init__(self, spark: SparkSession):
        self.spark, self.rows, self.errors = spark, [], {}
        self._ended: set[str] = set()
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        held, size = (sum(getattr(s, n) for s in p.stateOperators) for n in ("numRowsTotal", "memoryUsedBytes"))
        row = (p.name or str(p.id), str(p.runId), p.batchId, p.timestamp, p.numInputRows, late, held, size, (p.durationMs or {}).get("triggerExecution"), (p.eventTime or {}).get("watermark"))
        with self._news:
            self.rows.append(row)

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            if event.exception:
                self.errors[str(event.runId)] = event.exception
            self._news.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until everything that a finished query reported has arrived (reports come on another thread)."""
        with self._news:
            if not self._news.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"no end reported for {query.name or query.id}")

    def table(self) -> DataFrame:
        with self._news:
            return self.spark.createDataFrame(list(self.rows), SHAPE)


@contextmanager
def followed(spark: SparkSession) -> Iterator[Accounts]:
    """Follow every query started inside the block."""
    accounts = Accounts(spark)
    spark.streams.addListener(accounts)
    try:
        yield accounts
    finally:
        spark.streams.removeListener(accounts)
