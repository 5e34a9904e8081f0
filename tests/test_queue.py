"""The marked queue against a plain loop, over several batches, with feedback that comes late and a crash."""

import hashlib

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from millrace.streaming import jobs, queue

DAY = 86_400
BASE = 1_700_000_000


def put(spark, path, rows):
    df = spark.createDataFrame(rows, "request long, r long, status string, f long")
    at = lambda c: F.when(F.col(c).isNotNull(), F.timestamp_seconds(F.col(c) + BASE))
    df.select("request", at("r").alias("requested_at"), "status", at("f").alias("feedback_at")).coalesce(1).write.mode("append").parquet(path)


def sampled(request):
    return int(hashlib.md5(f"{request}queue".encode()).hexdigest()[:15], 16) % 100 < 10


def expected(rows):
    asked, first = {}, {}
    for request, r, status, f in rows:
        if request is None:
            continue
        if f is None:
            asked[request] = (r, status)
        else:
            first[request] = min(f, first.get(request, f))
    timely = {q for q, f in first.items() if q in asked and 0 <= f - asked[q][0] <= 30 * DAY}
    return {q: status or ("to_process" if sampled(q) or q in timely else "skipped") for q, (r, status) in asked.items()}


def test_queue_over_batches_and_a_crash(spark, tmp_path):
    src, ckpt = f"{tmp_path}/in", f"{tmp_path}/ckpt"
    requests = [(i, i * 60, "done" if i % 50 == 0 else None, None) for i in range(200)] + [(None, 5, None, None)]
    early = [(i, i * 60, None, i * 60 + DAY) for i in range(0, 40, 3)]
    # in time; at the last moment; too late; before the request; twice; without a request; for a finished one
    late = [(41, 41 * 60, None, 41 * 60 + 30 * DAY), (42, 42 * 60, None, 42 * 60 + 30 * DAY + 1), (43, 43 * 60, None, 43 * 60 - 5),
            (44, 44 * 60, None, 44 * 60 + 9), (44, 44 * 60, None, 44 * 60 + 7), (999, 5, None, 9), (100, 6000, None, 6001)]
    parts = [requests[:120] + early, requests[120:], late, requests[:5]]
    for p in parts[:2]:
        put(spark, src, p)
    stream = lambda: queue.claims(jobs.file_stream(spark, src, queue.SHAPE, max_files=1))
    log = jobs.UpdateLog(spark, f"{tmp_path}/log", stream().schema)
    state = lambda: {r["request"]: r["status"] for r in log.latest(["request"]).collect()}

    def failing(df, batch):
        log.write(df, batch)
        if batch == 1:
            raise OSError("the writer is lost")

    with pytest.raises(StreamingQueryException):
        queue.mark(stream(), log, ckpt, failing)
    queue.mark(stream(), log, ckpt)
    assert state() == expected(parts[0] + parts[1])
    assert state()[44] == "skipped" or sampled(44)
    for p in parts[2:]:
        put(spark, src, p)
    queue.mark(stream(), log, ckpt)
    final = state()
    assert final == expected([r for p in parts for r in p])
    assert final[41] == final[44] == "to_process" and final[100] == "done" and 999 not in final
    queue.mark(stream(), log, ckpt)  # nothing new: nothing changes
    assert state() == final
