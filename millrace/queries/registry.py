"""Registered queries: each a function of the tables, most with a DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy access to the parquet tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def views(self, *names: str) -> SparkSession:
        for n in names:
            getattr(self, n).createOrReplaceTempView(n)
        return self.spark


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rnd(col: Column | str, digits: int = 4) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast("double"), digits)


def day(col: Column | str) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def ntz(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("timestamp_ntz")
