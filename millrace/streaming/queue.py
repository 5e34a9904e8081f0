"""A queue of requests that a stream marks: a sample and everything with timely feedback is to be processed, the rest skipped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import hash_bucket
from millrace.streaming.jobs import UpdateLog

#: One row per request (``feedback_at`` null) and per feedback (``status`` null). Feedback names its request by id and time.
SHAPE = "request long, requested_at timestamp, status string, feedback_at timestamp"


def claims(stream: DataFrame, within: str = "30 days", keep: str = "60 days", percent: int = 10, salt: str = "queue") -> DataFrame:
    """The status of every request that a batch touches, as an update-mode stream.

    A request that brings a status keeps it. Others are ``to_process`` if the hash of their id falls into the
    sample or their first feedback comes at most ``within`` after them, else ``skipped``; feedback that
    arrives in a later batch changes ``skipped`` to ``to_process``. Feedback whose request was never seen marks
    nothing. Null ids are dropped. The state, one small row per request, is let go ``keep`` after the request.
    """
    rows = stream.where("request IS NOT NULL AND requested_at IS NOT NULL").withWatermark("requested_at", keep)
    seen = rows.groupBy("request", "requested_at").agg(
        F.max("status").alias("given"), F.min("feedback_at").alias("feedback_at"),
        F.max(F.col("feedback_at").isNull()).alias("asked"))
    timely = F.col("feedback_at").between(F.col("requested_at"), F.col("requested_at") + F.expr(f"INTERVAL {within}"))
    picked = (hash_bucket(F.col("request"), 100, salt) < percent) | F.coalesce(timely, F.lit(False))
    status = F.coalesce("given", F.when(picked, "to_process").otherwise("skipped"))
    return seen.where("asked").select("request", "requested_at", status.alias("status"), "feedback_at")


def mark(marked: DataFrame, log: UpdateLog, checkpoint: str, write=None) -> None:
    """Bring the queue up to date with all input there is. A batch that is repeated after a crash replaces its own rows."""
    query = marked.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write or log.write)
    query.trigger(availableNow=True).start().awaitTermination()
