"""Ordered per-key computations that survive a key holding a large part of the table.

A plain ``Window.partitionBy(key)`` sends a whole key to one task. Here every key with more
than ``share`` of the rows is cut along its whole order into chunks: Spark's range partitioning
of the heavy keys' rows by (key, order), so each key is cut at quantiles of its own. Window
functions run inside (key, chunk); a one-row summary per chunk is then scanned per key and its
running result is joined back as the carry-in of each chunk. Light keys keep a single chunk and
see exactly the plan of the plain window, and so does any input that is small as a whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import conf_int, materialize, plan_bytes

CHUNK = "__chunk"
WHOLE = -1  # chunk of keys that are not cut
# Inputs whose files are below this size are never split: no task can get more than their rows. Files hold
# rows ten and more times smaller than a sort does, so the size is well below what a task may hold.
SMALL_BYTES_CONF = "spark.millrace.split.smallBytes"
SMALL_BYTES = 32 << 20
# A key is heavy above this share of all rows, so there are at most 1/share heavy keys. Where the input's
# size is known, the share is lowered until it stands for HEAVY_BYTES: a light key then fits one task at any size.
HEAVY_SHARE = 1.0 / 4096
HEAVY_BYTES = 1 << 30
# Inputs that are not files have no true size; their estimate lies above this.
UNKNOWN_BYTES = 1 << 60
# A chunk gets no more of the input's files, and no more rows, than these: well packed files hold very many rows.
TARGET_CHUNK_BYTES = 32 << 20
TARGET_CHUNK_ROWS = 500_000
LEAST_CHUNKS = 8


def is_small(df: DataFrame) -> bool:
    size = plan_bytes(df)
    return size is not None and size < conf_int(df.sparkSession, SMALL_BYTES_CONF, SMALL_BYTES)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result once if it is large and about to be read several times."""
    return df if is_small(df) else materialize(df, label)


def heavy_counts(df: DataFrame, keys: Sequence[str], share: float = HEAVY_SHARE) -> tuple[DataFrame, int]:
    """Keys holding more than ``share`` of the rows (at most ``1/share`` of them), and how many rows they hold together.

    One job: partial counts combine map-side, the ordered limit keeps only the largest
    ``1/share`` groups, and the total is observed on the way.
    """
    limit = int(1 / share)
    total = Observation()
    counts = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .observe(total, F.coalesce(F.sum("__rows"), F.lit(0)).alias("n"))
    )
    top = counts.orderBy(F.desc("__rows")).limit(limit).collect()
    floor = (total.get["n"] if top else 0) * share
    found = [r for r in top if r["__rows"] > floor]
    schema = T.StructType([f for f in counts.schema.fields if f.name != "__rows"])
    return df.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in found], schema), sum(r["__rows"] for r in found)


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float = HEAVY_SHARE) -> DataFrame:
    """Keys holding more than ``share`` of the rows: at most ``1/share`` of them."""
    return heavy_counts(df, keys, share)[0]


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """``right`` with renamed keys, and the null-safe equality that joins it to ``left``."""
    renamed = right
    for i, k in enumerate(keys):
        renamed = renamed.withColumnRenamed(k, f"__key{i}")
    condition = F.lit(True)
    for i, k in enumerate(keys):
        condition = condition & left[k].eqNullSafe(renamed[f"__key{i}"])
    return renamed, condition


class OrderedGroups:
    """Rows grouped by ``keys`` and ordered by ``order`` (ascending, ideally a total order).

    Groups are cut along the whole order, whatever the columns' types; only rows that tie on all of it stay
    together, as nothing tells them apart. ``always`` cuts heavy keys of small inputs too. ``chunks`` is the
    number of chunks over all heavy keys; without it a chunk gets at most some TARGET_CHUNK_BYTES and TARGET_CHUNK_ROWS.
    Chunks are dealt to as many partitions as there are chunks, so what a task gets does not grow with the table.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str], *, chunks: int | None = None,
                 share: float = HEAVY_SHARE, always: bool = False, _split: bool | None = None, _carried: bool = False, _parts: int | None = None):
        self.keys, self.order = list(keys), list(order)
        self.split, self.parts = bool(_split), _parts
        self._has_carry = _carried
        if _split is not None:
            self.df = df
            return
        self.df = df.withColumn(CHUNK, F.lit(WHOLE))
        if self.keys and not always and is_small(df):
            return
        size = plan_bytes(df)
        known = size if size and size < UNKNOWN_BYTES else None
        light, hot = None, df
        if self.keys:
            heavy, rows = heavy_counts(df, self.keys, min(share, HEAVY_BYTES / known) if known else share)
            if not rows:
                return
            marks, on = null_safe(df, heavy.withColumn("__heavy", F.lit(True)), self.keys)
            # the heavy list has at most 1/share rows by construction
            marked = df.join(F.broadcast(marks), on, "left").drop(*[f"__key{i}" for i in range(len(self.keys))])
            light, hot = (marked.where(c).drop("__heavy") for c in ("__heavy IS NULL", "__heavy"))
        else:
            rows = df.count()
        n = chunks or max(LEAST_CHUNKS, -(-known // TARGET_CHUNK_BYTES) if known else 0, -(-rows // TARGET_CHUNK_ROWS))
        # written, as a second evaluation could sample other borders
        cut = materialize(hot.repartitionByRange(n, *self.keys, *self.order).withColumn(CHUNK, F.spark_partition_id()), "chunks")
        self.df = cut if light is None else light.withColumn(CHUNK, F.lit(WHOLE)).unionByName(cut)
        self.split, self.parts = True, max(n, conf_int(df.sparkSession, "spark.sql.shuffle.partitions", 200))

    # -- plumbing ---------------------------------------------------------------------
    def _with(self, df: DataFrame, carried: bool = False) -> OrderedGroups:
        return OrderedGroups(df, self.keys, self.order, _split=self.split, _carried=carried or self._has_carry, _parts=self.parts)

    def window(self) -> Window:
        return Window.partitionBy(*self.keys, CHUNK).orderBy(*self.order)

    def where(self, condition) -> OrderedGroups:
        return self._with(self.df.where(condition))

    def with_columns(self, columns: Mapping[str, Column]) -> OrderedGroups:
        return self._with(self.df.withColumns(dict(columns)))

    def result(self) -> DataFrame:
        return self.df.drop(CHUNK)

    def _carried(self, summaries: Mapping[str, Column], scans: Mapping[str, Column], back: bool = False) -> DataFrame:
        """Join each chunk's carry-in: ``scans`` over the per-chunk ``summaries`` before it.

        Only cut keys are summarised, so the summary has at most (heavy keys x chunks) rows
        whatever the table size; being keyed by chunk, the join cannot skew either. Rows are
        read twice here (summary and result). A second step would read its input twice again,
        so a result that already holds a carry is written once first: cost stays linear.
        """
        if self._has_carry:
            self.df, self._has_carry = materialize(self.df, "ordered"), False
        cut = self.df.where(F.col(CHUNK) > WHOLE)
        per_chunk = cut.groupBy(*self.keys, CHUNK).agg(*[c.alias(n) for n, c in summaries.items()])
        if self.keys:
            order = F.desc(CHUNK) if back else F.asc(CHUNK)
            w = Window.partitionBy(*self.keys).orderBy(order)
        else:
            w = Window.partitionBy(F.lit(0)).orderBy(F.desc(CHUNK) if back else F.asc(CHUNK))
        w = w.rowsBetween(Window.unboundedPreceding, -1)
        carry = per_chunk.select(
            *self.keys, CHUNK, F.count(F.lit(1)).over(w).alias("__before"), *[c.over(w).alias(n) for n, c in scans.items()]
        ).where("__before > 0").drop("__before")
        # the windows that follow find their rows dealt already; the summary has few rows, so the rows stay where they are
        dealt = self.df.repartition(self.parts, *self.keys, CHUNK)
        side, on = null_safe(dealt, carry, [*self.keys, CHUNK])
        return dealt.join(F.broadcast(side), on, "left").drop(*[f"__key{i}" for i in range(len(self.keys) + 1)])

    def _position(self) -> Column:
        return F.struct(*self.order)

    # -- operations -------------------------------------------------------------------
    def lag(self, columns: Mapping[str, str]) -> OrderedGroups:
        return self._neighbour(columns, back=False)

    def lead(self, columns: Mapping[str, str]) -> OrderedGroups:
        return self._neighbour(columns, back=True)

    def _neighbour(self, columns: Mapping[str, str], back: bool) -> OrderedGroups:
        shift = F.lead if back else F.lag
        if not self.split:
            return self.with_columns({out: shift(src).over(self.window()) for out, src in columns.items()})
        packed = F.struct(*[F.col(src).alias(f"f{i}") for i, src in enumerate(columns.values())])
        edge = F.min_by(packed, self._position()) if back else F.max_by(packed, self._position())
        df = self._carried({"__edge": edge}, {"__edge": F.last("__edge")}, back)
        df = df.withColumn("__near", F.coalesce(shift(packed).over(self.window()), F.col("__edge")))
        df = df.withColumns({out: F.col(f"__near.f{i}") for i, out in enumerate(columns)})
        return self._with(df.drop("__near", "__edge"), carried=True)

    def running(self, columns: Mapping[str, tuple[str, Column]], peers: bool = False) -> OrderedGroups:
        """Running ``sum``/``count``/``max``/``min`` up to and including the current row.

        With ``peers`` rows that tie on the whole order count as one step (a RANGE frame).
        """
        frame = self.window().rangeBetween if peers else self.window().rowsBetween
        w = frame(Window.unboundedPreceding, Window.currentRow)
        fold = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}
        if not self.split:
            return self.with_columns({out: fold[op](c).over(w) for out, (op, c) in columns.items()})
        summaries = {f"__c_{out}": fold[op](c) for out, (op, c) in columns.items()}
        again = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}
        df = self._carried(summaries, {f"__c_{out}": again[op](F.col(f"__c_{out}")) for out, (op, _) in columns.items()})
        made = {}
        for out, (op, c) in columns.items():
            here, before = fold[op](c).over(w), F.col(f"__c_{out}")
            if op == "max":
                made[out] = F.greatest(here, before)
            elif op == "min":
                made[out] = F.least(here, before)
            elif op == "count":
                made[out] = here + F.coalesce(before, F.lit(0))
            else:
                made[out] = F.coalesce(here + before, here, before)
        df = df.withColumns(made).drop(*summaries)
        return self._with(df, carried=True)

    def running_before(self, columns: Mapping[str, tuple[str, Column]]) -> OrderedGroups:
        """Like :meth:`running`, but without the current row."""
        inner = {f"__r_{out}": spec for out, spec in columns.items()}
        step = self.running(inner).lag({out: f"__r_{out}" for out in columns})
        return step._with(step.df.drop(*inner))

    def row_number(self, name: str) -> OrderedGroups:
        return self.running({name: ("count", F.lit(1))})

    def last_value(self, columns: Mapping[str, Column]) -> OrderedGroups:
        """Last non-null value at or before the current row."""
        w = self.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        if not self.split:
            return self.with_columns({out: F.last(c, ignorenulls=True).over(w) for out, c in columns.items()})
        # Pick by position only among rows that carry a value; max_by skips null positions.
        summaries = {
            f"__v_{out}": F.max_by(c, F.when(c.isNotNull(), self._position())) for out, c in columns.items()
        }
        df = self._carried(summaries, {n: F.last(n, ignorenulls=True) for n in summaries})
        df = df.withColumns({
            out: F.coalesce(F.last(c, ignorenulls=True).over(w), F.col(f"__v_{out}")) for out, c in columns.items()
        })
        return self._with(df.drop(*summaries), carried=True)


def global_numbers(df: DataFrame, order: Sequence[str], name: str, start: int = 1, step: int = 1) -> DataFrame:
    """Gap-free numbering in a global order, without a single-task window."""
    numbered = OrderedGroups(df, [], order).row_number("__n").result()
    return numbered.withColumn(name, F.lit(start) + (F.col("__n") - 1) * F.lit(step)).drop("__n")
