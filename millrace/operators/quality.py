"""Row quality rules: warn, drop, fail, quarantine, and their event log.

A rule whose predicate is null counts as failed.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

ACTIONS = ("warn", "drop", "fail")
MAX_RULES = 1000


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    action: str = "drop"

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate).cast("boolean"), F.lit(False))


class QualityError(RuntimeError):
    """A rule with action ``fail`` was violated."""


def rules_from(table: DataFrame, tag: str, action: str = "drop") -> list[Rule]:
    """Rules of one tag from a ``tag, name, constraint`` table, in name order."""
    rows = table.where(F.col("tag") == tag).select("name", "constraint").limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules for {tag}")
    return [Rule(r["name"], r["constraint"], action) for r in sorted(rows, key=lambda r: r["name"])]


def all_hold(rules: Sequence[Rule]) -> Column:
    ok = F.lit(True)
    for r in rules:
        ok = ok & r.holds()
    return ok


def flag_failed(df: DataFrame, rules: Sequence[Rule], name: str = "failed_rules") -> DataFrame:
    """Add the names of the rules each row breaks."""
    marks = F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in rules])
    return df.withColumn(name, F.array_compact(marks))


def drop_failed(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.where(all_hold([r for r in rules if r.action == "drop"]))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Clean rows and their true complement, the latter with the broken rules."""
    flagged = flag_failed(df, rules)
    return flagged.where(F.size("failed_rules") == 0).drop("failed_rules"), flagged.where(F.size("failed_rules") > 0)


def counters(rules: Sequence[Rule]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows")] + [F.count_if(r.holds()).alias(f"passed_{i}") for i, r in enumerate(rules)]


def rule_counts(df: DataFrame, rules: Sequence[Rule], dataset: str, by: Sequence[str] = ()) -> DataFrame:
    """Passed, failed and dropped rows per rule (and per ``by`` column) in one aggregate."""
    totals = df.groupBy(*by).agg(*counters(rules))
    lines = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"), F.col(f"passed_{i}").alias("passed"),
                 (F.col("rows") - F.col(f"passed_{i}")).alias("failed")) for i, r in enumerate(rules)])
    out = totals.select(*by, F.explode(lines).alias("r")).select(F.lit(dataset).alias("dataset"), *by, "r.*")
    return out.withColumn("dropped", F.when(F.col("action") == "drop", F.col("failed")).otherwise(F.lit(0)).cast("long"))


class Watch:
    """Counts rules while the rows pass through (no extra scan); read after an action."""

    def __init__(self, dataset: str, rules: Sequence[Rule]):
        self.dataset, self.rules = dataset, list(rules)
        self._seen = Observation()

    def over(self, df: DataFrame) -> DataFrame:
        return drop_failed(df.observe(self._seen, *counters(self.rules)), self.rules)

    def check(self) -> None:
        seen = self._seen.get
        for i, r in enumerate(self.rules):
            failed = seen["rows"] - seen[f"passed_{i}"]
            if r.action == "fail" and failed:
                raise QualityError(f"{self.dataset}: {failed} rows break {r.name} ({r.predicate})")

    def events(self, update: str) -> list[tuple]:
        seen = self._seen.get
        out = []
        for i, r in enumerate(self.rules):
            passed = seen[f"passed_{i}"]
            failed = seen["rows"] - passed
            out.append((update, dt.datetime.now(dt.timezone.utc), self.dataset, r.name, r.action, passed, failed,
                        failed if r.action == "drop" else 0))
        return out


EVENT_SCHEMA = "update string, at timestamp, dataset string, rule string, action string, passed long, failed long, dropped long"


def fail_if_broken(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """Rows pass unchanged; the first row that breaks a ``fail`` rule aborts the job itself."""
    for r in rules:
        if r.action == "fail":
            message = F.lit(f"{dataset}: a row breaks {r.name} ({r.predicate})")
            df = df.where(F.when(r.holds(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return df


#: How the message of a broken rule reads, from which its name is taken again.
BROKEN = re.compile(r"a row breaks (\w+) ")


def update_or_keep(df: DataFrame, path: str) -> str | None:
    """Write ``df`` as the new state of the dataset at ``path``, all or nothing; the broken rule's name if one stops it.

    A job that fails commits no file, so readers of the dataset keep what was there.
    """
    try:
        df.write.mode("append").parquet(path)
    except PySparkException as error:
        found = BROKEN.search(str(error))
        if not found:
            raise
        return found[1]
    return None


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows in the declared contract: names, order, types and comments; nulls in required fields abort."""
    loose = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])
    shaped = df.to(loose)
    columns = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if not f.nullable:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"{f.name} is null")).cast(f.dataType)).otherwise(c)
        columns.append(c.alias(f.name, metadata=f.metadata))
    return shaped.select(*columns)
