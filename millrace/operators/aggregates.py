"""Aggregations beyond a plain group-by."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import OrderedGroups, null_safe, settle
from millrace.session import materialize


def totals_at_levels(df: DataFrame, levels: Sequence[Sequence[str]], measures: Sequence[Column], label: str = "ALL") -> DataFrame:
    """One aggregate at several grains; dropped keys read ``label`` (real nulls stay null).

    Grouping sets expand each row once per level, so rows are first combined at the finest
    grain by the map-side aggregate of the same stage.
    """
    keys = list(dict.fromkeys(k for level in levels for k in level))
    out = df.groupingSets([[F.col(k) for k in level] for level in levels], *[F.col(k) for k in keys]).agg(
        *[F.grouping(k).alias(f"__g_{k}") for k in keys], *measures)
    for k in keys:
        out = out.withColumn(k, F.when(F.col(f"__g_{k}") == 1, F.lit(label)).otherwise(F.col(k).cast("string")))
    return out.drop(*[f"__g_{k}" for k in keys])


def trailing_months(df: DataFrame, keys: Sequence[str], at: str, anchor: Column, months: Sequence[int],
                    measures: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """The same measures over several trailing horizons in one pass over the data.

    ``measures`` maps a name to (``sum|count|avg|max|min|distinct``, column); output columns are
    ``name_<n>m``. Rows older than the longest horizon are filtered at the scan.
    """
    fold = {"sum": F.sum, "count": F.count, "avg": F.avg, "max": F.max, "min": F.min, "distinct": F.count_distinct}
    inside = lambda n: F.col(at) >= F.add_months(anchor, -n)
    columns = [
        fold[op](F.when(inside(n), c)).alias(f"{name}_{n}m") for n in months for name, (op, c) in measures.items()
    ]
    return df.where(inside(max(months))).groupBy(*keys).agg(*columns)


def rollup_components(demand: DataFrame, bom: DataFrame, levels: int | None = None) -> DataFrame:
    """Push demand down a bill of materials level by level and total it per part.

    ``demand(part, need)``, ``bom(parent, child, qty)``. Each level aggregates before the next
    join, so the frontier never exceeds one row per part. Without ``levels`` it goes on until
    no demand is left, however deep the bill is; a path with more levels than there are parents goes in
    a circle, and is refused.
    Each level is written once to the shared folder, so a lost executor costs one level.
    """
    frontier = demand.withColumn("depth", F.lit(0))
    total = frontier
    most = bom.select("parent").distinct().count() if levels is None else levels
    for level in range(1, most + 2 if levels is None else most + 1):
        frontier = (
            frontier.join(bom, F.col("part") == F.col("parent"))
            .groupBy(F.col("child").alias("part"))
            .agg(F.sum(F.col("need") * F.col("qty")).alias("need"))
            .withColumn("depth", F.lit(level))
        )
        frontier = materialize(frontier, f"bom-level{level}")
        if levels is None and frontier.isEmpty():
            break
        total = total.unionByName(frontier)
    else:
        if levels is None:
            raise ValueError("the bill of materials goes in a circle")
    return total.groupBy("part").agg(F.sum("need").alias("total_need"), F.max("depth").alias("deepest"))


def ranks(df: DataFrame, keys: Sequence[str], value: str, rank: str, dense: str) -> DataFrame:
    """``rank`` and ``dense_rank`` by descending ``value`` of any type (nulls last), from counts of equal values.

    Only distinct values are ordered; the rows get their rank by an equality join, which
    splits hot keys, instead of all rows of a key passing through one window task.
    """
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    counts = settle(counts, "value-counts")
    done = OrderedGroups(counts, keys, [value]).running({"__upto": ("sum", F.col("__n")), "__place": ("count", F.lit(1))}).result()
    totals = counts.groupBy(*keys).agg(F.sum("__n").alias("__all"), F.count(F.lit(1)).alias("__values"))
    if keys:
        side, on = null_safe(done, totals, keys)
        done = done.join(side, on).drop(*[f"__key{i}" for i in range(len(keys))])
    else:
        done = done.withColumns({c: totals.select(c).scalar() for c in ("__all", "__values")})
    table = done.select(*keys, value, (F.col("__all") - F.col("__upto") + 1).alias(rank), (F.col("__values") - F.col("__place") + 1).alias(dense))
    side, on = null_safe(df, table, [*keys, value])
    return df.join(side, on).drop(*[f"__key{i}" for i in range(len(keys) + 1)])


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, marks: Mapping[str, float]) -> DataFrame:
    """Exact interpolated percentiles per key without holding a key's values in one task.

    Values are counted, numbered by a running sum, and the two neighbours of each mark are
    picked by combinable minima. (The built-in aggregate keeps every distinct value of a
    group in the memory of one task.)
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    counts = settle(counts, "value-counts")
    upto = OrderedGroups(counts, keys, [value]).running({"__upto": ("sum", F.col("__n"))}).result()
    totals = counts.groupBy(*keys).agg(F.sum("__n").alias("__all"))
    if keys:
        side, on = null_safe(upto, totals, keys)
        both = upto.join(side, on).drop(*[f"__key{i}" for i in range(len(keys))])
    else:
        both = upto.withColumn("__all", totals.select("__all").scalar())
    picks, out = [], []
    for i, (name, p) in enumerate(marks.items()):
        spot = F.lit(p) * (F.col("__all") - 1)
        picks += [F.min(F.when(F.col("__upto") > F.floor(spot), F.col(value))).alias(f"__lo{i}"), F.min(F.when(F.col("__upto") > F.ceil(spot), F.col(value))).alias(f"__hi{i}"),
                  F.max(spot - F.floor(spot)).alias(f"__w{i}")]
        low, high = F.col(f"__lo{i}").cast("double"), F.col(f"__hi{i}").cast("double")
        out.append((low + (high - low) * F.col(f"__w{i}")).alias(name))
    return both.groupBy(*keys).agg(*picks).select(*keys, *out)


def text_lists(df: DataFrame, keys: Sequence[str], order: Sequence[str], text: str, name: str, sep: str = "; ", size: int = 1000) -> DataFrame:
    """The texts of each key in ``order`` (a total order), joined, in segments of ``size`` texts: ``keys, segment, texts, name``.

    Numbering by chunks and the cut into segments keep a hot key from becoming one row or one task; no text is
    dropped. Null texts are left out before counting; empty ones stay.
    """
    told = df.where(F.col(text).isNotNull()).select(*{c: None for c in [*keys, *order, text]})
    groups = OrderedGroups(told, keys, order).row_number("__n")
    numbered = groups.result().withColumn("__segment", F.floor((F.col("__n") - 1) / size))
    if groups.split:  # as many parts as chunks: the texts of a key and segment come together whole
        numbered = numbered.repartition(groups.parts, *keys, "__segment")
    packed = numbered.groupBy(*keys, F.col("__segment").alias("segment")).agg(
        F.count(F.lit(1)).alias("texts"), F.sort_array(F.collect_list(F.struct("__n", F.col(text).alias("t")))).alias("__list"))
    return packed.select(*keys, "segment", "texts", F.array_join(F.col("__list.t"), sep).alias(name))
