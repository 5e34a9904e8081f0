"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("MILLRACE_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only where neither that setting nor a checkpoint folder exists (local tests) is
    a temporary folder made and set, once per session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="millrace-")
    spark.sparkContext.setCheckpointDir(root)
    return shared_root(spark)


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_root(spark)}/millrace/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, and lets several consumers
    share one computation.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def plan_bytes(df: DataFrame) -> int | None:
    """Total estimated size of the plan's leaves (files, local rows).

    Leaf sizes are real file sizes; the estimate of a whole plan is not used because it
    multiplies the sides of every join.
    """
    if not hasattr(df, "_jdf"):  # remote sessions have no JVM handle: treat as large
        return None
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def conf_int(spark: SparkSession, name: str, default: int) -> int:
    return int(spark.conf.get(name, str(default)))


def rebalanced(df: DataFrame, *by: str) -> DataFrame:
    """Rows brought together by columns before a partitioned write, in even parts.

    With AQE the rebalance step splits a value that holds much of the table over several
    tasks and files, and joins small ones, so files come out near the advisory size.
    """
    return df.hint("rebalance", *[F.col(c) for c in by])
