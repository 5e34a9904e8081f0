"""Named datasets with dependencies and rules, refreshed in order.

A dataset function receives its inputs by parameter name. Views stay lazy; tables are
written once to the shared folder (or as the next version of a versioned table) and read
back, so every consumer and every retry sees the same rows.
"""

from __future__ import annotations

import inspect
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.quality import EVENT_SCHEMA, Rule, Watch, conform
from millrace.session import work_dir
from millrace.sources.snapshots import VersionedTable


@dataclass
class Dataset:
    name: str
    build: Callable[..., DataFrame]
    kind: str
    rules: Sequence[Rule] = ()
    schema: object = None
    inputs: tuple[str, ...] = ()


@dataclass
class Pipeline:
    spark: SparkSession
    root: str | None = None
    datasets: dict[str, Dataset] = field(default_factory=dict)

    def _add(self, kind: str, rules: Sequence[Rule], schema, name: str | None):
        def register(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
            key = name or fn.__name__
            if key in self.datasets:
                raise ValueError(f"dataset {key} is defined twice")
            self.datasets[key] = Dataset(key, fn, kind, rules, schema, tuple(inspect.signature(fn).parameters))
            return fn

        return register

    def table(self, rules: Sequence[Rule] = (), schema=None, name: str | None = None):
        return self._add("table", rules, schema, name)

    def view(self, rules: Sequence[Rule] = (), schema=None, name: str | None = None):
        return self._add("view", rules, schema, name)

    def order(self) -> list[str]:
        graph = {d.name: [i for i in d.inputs if i in self.datasets] for d in self.datasets.values()}
        missing = {i for d in self.datasets.values() for i in d.inputs if i not in self.datasets}
        if missing:
            raise ValueError(f"unknown inputs {sorted(missing)}")
        return list(TopologicalSorter(graph).static_order())

    def lineage(self) -> DataFrame:
        edges = [(i, d.name, d.kind) for d in self.datasets.values() for i in d.inputs]
        return self.spark.createDataFrame(edges, "input string, output string, kind string")

    def refresh(self, replace: dict[str, DataFrame] | None = None) -> Run:
        """Build every dataset once. ``replace`` swaps named datasets for given rows (test profiles)."""
        update = uuid.uuid4().hex
        made: dict[str, DataFrame] = {}
        events: list[tuple] = []
        for name in self.order():
            d = self.datasets[name]
            rows = (replace or {}).get(name)
            if rows is None:
                rows = d.build(**{i: made[i] for i in d.inputs})
            if d.schema is not None:
                rows = conform(rows, d.schema)
            made[name] = self._store(d, rows, events, update)
        return Run(self.spark, update, made, events)

    def _store(self, d: Dataset, rows: DataFrame, events: list[tuple], update: str) -> DataFrame:
        if d.kind == "view" and not d.rules:
            return rows
        watch = Watch(d.name, d.rules) if d.rules else None
        kept = watch.over(rows) if watch else rows
        # rows go to a scratch path first: a failed rule leaves the published version untouched
        path = work_dir(self.spark, f"dataset-{d.name}")
        kept.write.parquet(path)
        if watch:
            watch.check()
            events.extend(watch.events(update))
        stored = self.spark.read.schema(kept.schema).parquet(path)
        if self.root and d.kind == "table":
            table = VersionedTable(self.spark, f"{self.root}/{d.name}")
            table.publish(stored, "refresh", batch=update)
            return table.read()
        return stored


@dataclass
class Run:
    spark: SparkSession
    update: str
    tables: dict[str, DataFrame]
    _events: list[tuple]

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def events(self) -> DataFrame:
        return self.spark.createDataFrame(self._events, EVENT_SCHEMA)
