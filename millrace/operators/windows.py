"""Aggregates of the points inside time windows, by ranks instead of pairs.

Points are numbered in the order of time, so a window is a range of numbers. Counts and sums are differences of running
totals at its two ends. What cannot be subtracted (least value, distinct items) is put together from dyadic blocks of
numbers: a range of n points is at most 2 log2(n) of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import OrderedGroups, global_numbers, settle
from millrace.session import materialize

#: Sums are kept as decimals, whose differences lose nothing.
EXACT = "decimal(38,6)"


def _blocks(first: Column, end: Column, levels: int) -> Column:
    """The (level, block) parts of the numbers from ``first`` up to ``end``, which stays outside."""
    start = F.struct(first.alias("lo"), end.alias("hi"), F.array().cast("array<struct<level:int,block:bigint>>").alias("all"))

    def step(acc: Column, level: Column) -> Column:
        lo, hi = acc["lo"], acc["hi"]
        left = (lo < hi) & (lo % 2 == 1)
        lo = F.when(left, lo + 1).otherwise(lo)
        right = (lo < hi) & (hi % 2 == 1)
        part = lambda block: F.array(F.struct(level.cast("int").alias("level"), block.alias("block")))
        none = F.array().cast("array<struct<level:int,block:bigint>>")
        more = F.concat(acc["all"], F.when(left, part(acc["lo"])).otherwise(none), F.when(right, part(hi - 1)).otherwise(none))
        return F.struct(F.shiftright(lo, 1).alias("lo"), F.shiftright(F.when(right, hi - 1).otherwise(hi), 1).alias("hi"), more.alias("all"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(levels)), start, step, lambda acc: acc["all"])


def window_totals(windows: DataFrame, window_id: str, bounds: tuple[str, str], points: DataFrame, at: str, value: str, item: str, label: str) -> DataFrame:
    """``window_id``, n, total, items, least: per window the points at or between its bounds.

    ``total`` sums ``value``, ``items`` counts distinct ``item``, ``least`` is the smallest ``label``; nulls of these
    are left out. Windows without points, with a null bound or an end before the start have no row; ids that repeat are
    windows of their own and give a row each. Points with a null time are in no window.

    No pair of window and point is made: points appear once in each level of blocks up to the size of the fullest
    window, windows once in each of their blocks. A distinct item is counted at its first point inside the window, that is
    the one whose previous point of the same item lies before the window's start.
    """
    rows = points.where(F.col(at).isNotNull()).select(F.col(at).alias("t"), F.col(value).cast(EXACT).alias("x"), F.col(item).alias("item"), F.col(label).alias("label"))
    numbered = materialize(global_numbers(rows, ["t", "label"], "r", start=0), "points")
    spans = windows.where(F.col(bounds[0]) <= F.col(bounds[1])).select(F.col(window_id).alias("id"), F.col(bounds[0]).alias("s"), F.col(bounds[1]).alias("e"))
    spans = materialize(spans.withColumn("w", F.monotonically_increasing_id()), "windows")

    # a start comes before the points of its instant, an end after them
    nothing = F.lit(None).cast(EXACT).alias("x")
    marks = numbered.select("t", F.lit(1).alias("side"), "x", F.lit(1).alias("one"), F.lit(None).cast("long").alias("w")).unionByName(
        spans.select(F.col("s").alias("t"), F.lit(0).alias("side"), nothing, F.lit(0).alias("one"), "w")).unionByName(
        spans.select(F.col("e").alias("t"), F.lit(2).alias("side"), nothing, F.lit(0).alias("one"), "w"))
    ran = OrderedGroups(marks, [], ["t", "side"]).running({"n": ("sum", F.col("one")), "total": ("sum", F.coalesce("x", F.lit(0).cast(EXACT)))}).result()
    ends = ran.where("w IS NOT NULL").groupBy("w").agg(*[F.max(F.when(F.col("side") == side, F.col(c))).alias(f"{c}{side}") for side in (0, 2) for c in ("n", "total")])
    found = ends.join(spans.select("w", "id"), "w").select("w", "id", F.col("n0").alias("a"), F.col("n2").alias("b"), (F.col("total2") - F.col("total0")).alias("total")).where("b > a")
    found = materialize(found, "ranges")

    longest = found.agg(F.max(F.col("b") - F.col("a"))).first()[0]
    levels = max(0, (longest or 1).bit_length() - 1)
    asked = found.select("w", "a", F.explode(_blocks(F.col("a"), F.col("b"), levels)).alias("p")).select("w", "a", "p.*")
    before = OrderedGroups(numbered.where("item IS NOT NULL").select("item", "r"), ["item"], ["r"]).lag({"before": "r"}).result()
    level = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level")
    inside = F.expr("shiftright(r, level)").alias("block")
    least = numbered.select("r", "label", level).groupBy("level", inside).agg(F.min("label").alias("least"))
    smallest = asked.join(least, ["level", "block"]).groupBy("w").agg(F.min("least").alias("least"))

    # in a block: points by the number of their item's previous point, windows by their start
    firsts = before.select("r", F.coalesce("before", F.lit(-1)).alias("key"), level).select("level", inside, "key", F.lit(1).alias("one"), F.lit(None).cast("long").alias("w"))
    # of equal numbers the window goes first: a previous point at its very start lies inside it
    lined = firsts.withColumn("key", 2 * F.col("key") + 1).unionByName(asked.select("level", "block", (2 * F.col("a")).alias("key"), F.lit(0).alias("one"), "w"))
    counted = OrderedGroups(settle(lined, "blocks"), ["level", "block"], ["key"]).running({"fresh": ("sum", F.col("one"))}).result().where("w IS NOT NULL")
    distinct = counted.groupBy("w").agg(F.sum("fresh").alias("items"))
    out = found.join(smallest, "w").join(distinct, "w", "left")
    return out.select(F.col("id").alias(window_id), (F.col("b") - F.col("a")).alias("n"), "total", F.coalesce("items", F.lit(0)).alias("items"), "least")
