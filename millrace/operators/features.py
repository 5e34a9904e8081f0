"""Time-window features, training sets and encoders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import asof_join
from millrace.operators.ordered import OrderedGroups, settle


def rolling(df: DataFrame, keys: Sequence[str], at: str, seconds: int, aggs: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """``sum``/``count``/``min``/``max`` over ``[t - seconds, t]`` per key, linear in the rows.

    A sliding frame is recomputed for every row, which is quadratic for a busy key. Here time
    is cut into blocks as wide as the frame, so a frame is the end of one block and the start
    of the next: a running aggregate forwards in the row's own block, and one backwards in the
    block before, read at ``t - seconds``. Nothing is subtracted, so sums stay exact. Work is
    grouped by (key, block); blocks still too large are split again with a carry.
    Rows that tie on time see each other, as in a RANGE frame.
    """
    width = seconds * 1_000_000
    values = {out: f"__x{i}" for i, out in enumerate(aggs)}
    ops = {out: op for out, (op, _) in aggs.items()}
    t = F.unix_micros(F.col(at).cast("timestamp"))
    base = df.withColumns({**{values[o]: c for o, (_, c) in aggs.items()}, "__t": t}).withColumn("__block", F.floor(F.col("__t") / width))
    groups = [*keys, "__block"]
    forward = OrderedGroups(base, groups, ["__t"]).running({f"__f_{o}": (ops[o], F.col(x)) for o, x in values.items()}, peers=True).result()
    forward = settle(forward, "rolling")
    # every row asks the block before for its tail from t - seconds on; backwards order is -t
    asks = forward.drop(*values.values()).withColumns({"__block": F.col("__block") - 1, "__back": width - F.col("__t"), "__ask": F.lit(True)}).drop("__t")
    rows = forward.select(*groups, *values.values(), (-F.col("__t")).alias("__back"))
    both = rows.unionByName(asks, allowMissingColumns=True)
    back = OrderedGroups(both, groups, ["__back"]).running({f"__b_{o}": (ops[o], F.col(x)) for o, x in values.items()}, peers=True).where("__ask").result()
    merged = {}
    for o, op in ops.items():
        f, b = F.col(f"__f_{o}"), F.col(f"__b_{o}")
        if op == "count":
            merged[o] = f + F.coalesce(b, F.lit(0))
        elif op == "sum":
            merged[o] = F.coalesce(f + b, f, b)
        else:
            merged[o] = F.greatest(f, b) if op == "max" else F.least(f, b)
    return back.withColumns(merged).select(*df.columns, *aggs)


@dataclass(frozen=True)
class TimeWindow:
    """``continuous``: ``[t - size, t]`` at each row; ``tumbling``; ``sliding`` by ``slide``. Seconds."""

    kind: str
    size: int
    slide: int | None = None


@dataclass(frozen=True)
class Feature:
    name: str
    function: str  # sum, avg, count, min, max, stddev_samp, ...
    column: str
    where: str | None = None


FUNCTIONS = {"sum": F.sum, "avg": F.avg, "count": F.count, "min": F.min, "max": F.max,
             "stddev_samp": F.stddev_samp, "stddev_pop": F.stddev_pop, "approx_count_distinct": F.approx_count_distinct}


def window_features(df: DataFrame, entity: Sequence[str], at: str, window: TimeWindow, features: Sequence[Feature]) -> DataFrame:
    """Features of each entity over a time window, from a declarative list.

    Tumbling and sliding windows give one row per entity and window (``window_start``,
    ``window_end``) and combine map-side; continuous windows give one row per input row.
    """
    inputs = {f.name: F.col(f.column) if f.where is None else F.when(F.expr(f.where), F.col(f.column)) for f in features}
    if window.kind == "continuous":
        return _continuous(df, entity, at, window.size, features, inputs)
    aggs = {f.name: FUNCTIONS[f.function](inputs[f.name]) for f in features}
    size = f"{window.size} seconds"
    span = F.window(at, size) if window.kind == "tumbling" else F.window(at, size, f"{window.slide} seconds")
    out = df.groupBy(*entity, span.alias("w")).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(*entity, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *aggs)


def _continuous(df: DataFrame, entity: Sequence[str], at: str, size: int, features: Sequence[Feature], inputs: Mapping[str, Column]) -> DataFrame:
    """Continuous windows from rolling sums, counts and extremes."""
    parts: dict[str, tuple[str, Column]] = {}
    for f in features:
        x = inputs[f.name]
        if f.function in ("sum", "count", "min", "max"):
            parts[f.name] = (f.function, x)
            continue
        if f.function not in ("avg", "stddev_samp", "stddev_pop"):
            raise ValueError(f"{f.function} is not available over continuous windows")
        # moments about the overall mean, so that squares do not swamp the spread
        centred = x.cast("double") - F.coalesce(df.select(F.avg(x)).scalar(), F.lit(0.0))
        parts |= {f"__n_{f.name}": ("count", x), f"__s_{f.name}": ("sum", x), f"__c_{f.name}": ("sum", centred), f"__q_{f.name}": ("sum", centred * centred)}
        if f.function == "avg":
            for extra in ("c", "q"):
                parts.pop(f"__{extra}_{f.name}")
    out = rolling(df, entity, at, size, parts)
    for f in features:
        n, s, c, q = (F.col(f"__{k}_{f.name}") for k in "nscq")
        if f.function == "avg":
            out = out.withColumn(f.name, F.try_divide(s, n))
        elif f.function.startswith("stddev"):
            spread = F.greatest(F.lit(0.0), q - c * c / n)
            out = out.withColumn(f.name, F.sqrt(F.try_divide(spread, n - 1 if f.function == "stddev_samp" else n)))
    return out.select(*df.columns, *[f.name for f in features])


@dataclass(frozen=True)
class Lookup:
    """Columns of a feature table by key; with ``at`` the row in force at the label's time."""

    table: DataFrame
    keys: Sequence[str]
    columns: Sequence[str]
    at: str | None = None
    tiebreak: Sequence[str] = ()


def training_set(labels: DataFrame, label_ts: str, lookups: Sequence[Lookup], exclude: Sequence[str] = ()) -> DataFrame:
    """Labels with all looked-up features; nothing later than the label's time is used."""
    out = labels
    for look in lookups:
        if look.at is None:
            out = out.join(look.table.select(*look.keys, *look.columns), list(look.keys), "left")
        else:
            # each lookup reads its input more than once; large inputs are settled in between
            out = settle(out, "labels")
            out = asof_join(out, look.table, look.keys, label_ts, look.at, look.columns, look.tiebreak).drop(f"matched_{look.at}")
    return out.drop(*exclude)


def categories(df: DataFrame, column: str, most: int = 1000) -> list:
    """Distinct values for one-hot columns; more than ``most`` is refused."""
    values = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"{column} has more than {most} values")
    return sorted(values)


def one_hot(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.withColumns({
        f"{column}_{v}": F.when(F.col(column) == v, 1).otherwise(0) for v in values}).drop(column)
