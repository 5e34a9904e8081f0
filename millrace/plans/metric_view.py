"""Metric views: named dimensions and measures over a source, queried at any grain.

A view is a small YAML or dict spec. ``query`` builds an ordinary DataFrame: joins, dimension
columns, one aggregate per kind of measure, then composed measures on top.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import yaml
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ordered import OrderedGroups
from millrace.session import materialize

REF = re.compile(r"MEASURE\(\s*`?([^`)]+?)`?\s*\)", re.IGNORECASE)
ADDITIVE = re.compile(r"(?:sum|count)\((?!\s*distinct)[^()]*(?:\([^()]*\)[^()]*)*\)", re.IGNORECASE)
DISTINCT = re.compile(r"count\(\s*distinct\s+([^(),]+)\)", re.IGNORECASE)
TRAILING = re.compile(r"trailing\s+(\d+)\s+(day|week|month|year)s?", re.IGNORECASE)


@dataclass(frozen=True)
class Reach:
    order: str
    range: str
    semiadditive: str = "last"


@dataclass(frozen=True)
class Measure:
    name: str
    expr: str
    window: Reach | None = None

    def needs(self) -> list[str]:
        return REF.findall(self.expr)


@dataclass
class MetricView:
    source: str
    dimensions: dict[str, str]
    measures: dict[str, Measure]
    joins: list[dict] = field(default_factory=list)
    filter: str | None = None

    @classmethod
    def from_yaml(cls, text: str) -> MetricView:
        spec = yaml.safe_load(text)
        measures = {}
        for m in spec.get("measures", []):
            win = m.get("window")
            window = Reach(win[0]["order"], str(win[0]["range"]), win[0].get("semiadditive", "last")) if win else None
            measures[m["name"]] = Measure(m["name"], m["expr"], window)
        # YAML 1.1 reads a bare `on` key as true
        joins = [{("on" if k is True else k): v for k, v in j.items()} for j in spec.get("joins", [])]
        return cls(spec["source"], {d["name"]: d["expr"] for d in spec["dimensions"]}, measures, joins, spec.get("filter"))

    # -- rows with dimension columns ----------------------------------------------------
    def _base(self, tables: Callable[[str], DataFrame], dims: Sequence[str]) -> DataFrame:
        base = tables(self.source).alias("source")
        if self.filter:
            base = base.where(F.expr(self.filter))
        for j in self.joins:
            # a join must be many-to-one, or measures would count source rows twice
            side = tables(j["source"])
            if "using" in j:
                side = side.alias(j["name"])
                on = F.lit(True)
                for k in j["using"]:
                    on = on & (F.col(f"source.{k}") == F.col(f"{j['name']}.{k}"))
            else:
                side, on = side.alias(j["name"]), F.expr(j["on"])
            base = base.join(side, on, "left")
        return base.withColumns({d: F.expr(self.dimensions[d]) for d in dims})

    def check_joins(self, tables: Callable[[str], DataFrame]) -> list[str]:
        """Joins declared with ``using`` whose keys are not unique on the joined side."""
        bad = []
        for j in self.joins:
            if "using" in j and not tables(j["source"]).groupBy(*j["using"]).count().where("count > 1").isEmpty():
                bad.append(j["name"])
        return bad

    def _ordered(self, names: Sequence[str]) -> list[str]:
        """Measures with everything they refer to, referenced ones first."""
        out: list[str] = []

        def visit(name: str, path: tuple[str, ...]) -> None:
            if name in path:
                raise ValueError("measures refer to each other: " + " -> ".join([*path, name]))
            if name not in self.measures:
                raise ValueError(f"unknown measure {name}")
            for other in self.measures[name].needs():
                visit(other, (*path, name))
            if name not in out:
                out.append(name)

        for n in names:
            visit(n, ())
        return out

    def _mentioned(self, texts: Sequence[str]) -> set[str]:
        return {d for d in self.dimensions for text in texts if re.search(rf"(?<!\w){re.escape(d)}(?!\w)", text)}

    # -- query --------------------------------------------------------------------------
    def query(self, tables: Callable[[str], DataFrame], dims: Sequence[str], measures: Sequence[str],
              where: str | None = None) -> DataFrame:
        """One row per combination of ``dims`` with the ``measures``.

        ``where`` is a predicate over dimensions, applied before the aggregates.
        """
        names = self._ordered(measures)
        plain = [n for n in names if not self.measures[n].needs() and self.measures[n].window is None]
        windowed = [n for n in names if self.measures[n].window is not None]
        composed = [n for n in names if self.measures[n].needs()]
        orders = [self.measures[n].window.order for n in windowed]
        texts = [self.measures[n].expr for n in plain + windowed] + ([where] if where else [])
        used = [d for d in self.dimensions if d in {*dims, *orders} | self._mentioned(texts)]
        base = self._base(tables, used)
        if where:
            base = base.where(F.expr(where))
        keys = list(dims)
        result = None
        if plain or not windowed:
            result = base.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
                *[F.expr(self.measures[n].expr).alias(n) for n in plain] or [F.count(F.lit(1)).alias("__n")])
        for group in self._by_window(windowed):
            part = self._windowed(base, keys, group)
            result = part if result is None else self._stitch(result, part, keys)
        for n in composed:
            text = REF.sub(lambda m: f"`{m.group(1)}`", self.measures[n].expr)
            result = result.withColumn(n, F.expr(text))
        return result.select(*[f"`{k}`" for k in keys], *[f"`{m}`" for m in measures])

    def _by_window(self, names: Sequence[str]) -> list[list[Measure]]:
        groups: dict[Reach, list[Measure]] = {}
        for n in names:
            groups.setdefault(self.measures[n].window, []).append(self.measures[n])
        return list(groups.values())

    def _stitch(self, left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
        l, r = left.alias("l"), right.alias("r")
        on = F.lit(True)
        for k in keys:
            on = on & F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`"))
        if not keys:  # both sides are single rows
            return left.withColumn("__one", F.lit(1)).join(right.withColumn("__one", F.lit(1)), "__one", "full").drop("__one")
        return l.join(r, on, "full").select(
            *[F.coalesce(F.col(f"l.`{k}`"), F.col(f"r.`{k}`")).alias(k) for k in keys],
            *[F.col(f"l.`{c}`") for c in left.columns if c not in keys],
            *[F.col(f"r.`{c}`") for c in right.columns if c not in keys])

    def _windowed(self, base: DataFrame, keys: Sequence[str], group: Sequence[Measure]) -> DataFrame:
        """Measures over a range of the order dimension ending at each anchor value.

        ``current`` uses rows of the anchor itself; ``trailing N unit`` uses rows in
        ``[anchor - N units, anchor)``, without the anchor. Rows are first combined per value of the
        order dimension, then spread to the anchors they count for. When the order dimension is not in the query, only the last anchor
        is reported (``semiadditive: last``).
        """
        win = group[0].window
        order = f"`{win.order}`"
        others = [k for k in keys if k != win.order]
        in_query = win.order in keys
        aggs = [F.expr(m.expr).alias(m.name) for m in group]
        rows = base
        if not in_query:
            last = base.agg(F.max(order)).first()[0]  # a single value
            anchor = F.lit(last)
            if win.range == "current":
                rows = rows.where(F.col(order) == anchor)
            else:
                step = self._interval(win)
                rows = rows.where((F.col(order) >= anchor - step) & (F.col(order) < anchor))
            return rows.groupBy(*[F.col(f"`{k}`") for k in others]).agg(*aggs)
        if win.range == "current":
            return rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*aggs)
        step = self._interval(win)
        spread = self._spread(base, order, win, step)
        at = [F.col(f"`{k}`") for k in others] + [F.col("__at")]
        here = [F.col(f"`{k}`") for k in others] + [F.col(order)]
        parts = []
        additive = [m for m in group if ADDITIVE.fullmatch(m.expr.strip())]
        if additive:
            # sums and counts: combine to one row per value before spreading to anchors
            small = rows.groupBy(*here).agg(*[F.expr(m.expr).alias(m.name) for m in additive])
            parts.append(spread(small).groupBy(*at).agg(*[F.sum(f"`{m.name}`").alias(m.name) for m in additive]))
        for m in group:
            one = DISTINCT.fullmatch(m.expr.strip())
            if one:
                parts.append(self._trailing_distinct(rows, others, order, one.group(1), step, m.name))
            elif m not in additive:
                parts.append(spread(rows).groupBy(*at).agg(F.expr(m.expr).alias(m.name)))
        named = parts[0]
        for part in parts[1:]:
            named = self._stitch(named, part, [*others, "__at"])
        found = named.withColumnRenamed("__at", win.order)
        # anchors with no rows before them keep a null
        grid = base.select(*[f"`{k}`" for k in keys]).distinct()
        return self._attach(grid, found, keys)

    def _spread(self, base: DataFrame, order: str, win: Reach, step: Column) -> Callable[[DataFrame], DataFrame]:
        """A function that gives rows the anchors they count for, as ``__at``."""
        n, unit = TRAILING.fullmatch(win.range.strip()).groups()
        spots = base.select(F.col(order).alias("__a")).distinct().where("__a IS NOT NULL")
        # anchor values that see a row of value v: the existing anchors in (v, v + N units]
        values = spots.withColumnRenamed("__a", "__v")
        unit_step = F.expr(f"INTERVAL 1 {unit}")
        grain = F.date_trunc(unit, F.col("__v"))
        reach = values.withColumn("__m", F.explode(F.sequence(grain, F.date_trunc(unit, F.col("__v") + step), unit_step)))
        anchors = spots.withColumn("__m", F.date_trunc(unit, F.col("__a")))
        # distinct values of one dimension on both sides, joined by equality on the unit they share
        seen = reach.join(anchors, "__m").where((F.col("__a") > F.col("__v")) & (F.col("__v") >= F.col("__a") - step))
        seen = seen.groupBy("__v").agg(F.collect_set("__a").alias("__anchors"))
        return lambda df: df.join(seen, F.col(order) == F.col("__v")).withColumn("__at", F.explode("__anchors"))

    def _trailing_distinct(self, rows: DataFrame, others: Sequence[str], order: str, item: str, step: Column, name: str) -> DataFrame:
        """Exact distinct counts at every anchor, linear in the distinct (item, value) pairs.

        An item seen at a value counts for the anchors after it up to the last one in reach: an interval of anchor
        numbers. An item's intervals rise with its values, so the part of one that its forerunner does not cover is known
        from that alone. What each part adds at its first and takes after its last number is summed per number, and a running
        total over the anchors gives the counts. A second count, of any row at all, tells no rows (null) from no items (0).
        """
        keys = {f"__g{i}": F.col(f"`{k}`") for i, k in enumerate(others)}
        # the one pass over the rows: everything else follows from the distinct items of a value
        pairs = rows.where(f"{order} IS NOT NULL").select(*[c.alias(n) for n, c in keys.items()], F.col(order).alias("__v"), F.expr(item).alias("__item")).distinct()
        pairs = materialize(pairs, "items-by-value")
        spots = pairs.select("__v").distinct()
        # an anchor reaches back to a value if its own start of reach lies at or before it
        marks = spots.select(F.explode(F.array(F.struct(F.col("__v").alias("__at"), F.lit(1).alias("__side"), F.col("__v")), F.struct(
            (F.col("__v") - step).alias("__at"), F.lit(0).alias("__side"), F.lit(None).cast(spots.schema["__v"].dataType).alias("__v")))).alias("m")).select("m.*")
        counts = {"__lo": ("sum", F.col("__side")), "__hi": ("sum", 1 - F.col("__side"))}
        reach = OrderedGroups(materialize(marks, "anchors"), [], ["__at", "__side"]).running(counts).result()
        # numbers of the anchors in reach: the next one up to the last
        reach = materialize(reach.where("__side = 1").select("__v", "__lo", (F.col("__hi") - 1).alias("__hi")), "reach")
        seen = pairs.join(reach, "__v")
        seen = seen.select(*keys, "__lo", "__hi", "__item", F.lit(0).alias("__any")).where("__item IS NOT NULL").unionByName(
            seen.select(*keys, "__lo", "__hi", F.lit(None).cast(seen.schema["__item"].dataType).alias("__item"), F.lit(1).alias("__any")).distinct())
        # at most one row for each anchor in a group
        ahead = F.lag("__hi").over(Window.partitionBy(*keys, "__any", "__item").orderBy("__lo"))
        fresh = seen.withColumn("__lo", F.greatest("__lo", F.coalesce(ahead + 1, F.lit(0)))).where("__lo <= __hi")
        ends = fresh.select(*keys, "__any", F.inline(F.array(F.struct(F.col("__lo").alias("__n"), F.lit(1).alias("__d")), F.struct((F.col("__hi") + 1).alias("__n"), F.lit(-1).alias("__d")))))
        grid = pairs.select(*keys, "__v").distinct().join(reach.select("__v", (F.col("__lo") - 1).alias("__n")), "__v")
        change = lambda any_: F.sum(F.when(F.col("__any") == any_, F.col("__d")).otherwise(0))
        changes = ends.withColumn("__v", F.lit(None).cast(grid.schema["__v"].dataType)).unionByName(
            grid.select(*keys, F.lit(0).alias("__any"), "__n", F.lit(0).alias("__d"), "__v"))
        changes = changes.groupBy(*keys, "__n").agg(change(0).alias("__items"), change(1).alias("__rows"), F.max("__v").alias("__v"))
        counts = OrderedGroups(materialize(changes, "changes"), list(keys), ["__n"]).running({"__items": ("sum", F.col("__items")), "__rows": ("sum", F.col("__rows"))}).result()
        counts = counts.where("__v IS NOT NULL AND __rows > 0")
        return counts.select(*[F.col(n).alias(k) for n, k in zip(keys, others)], F.col("__v").alias("__at"), F.col("__items").alias(name))

    def _attach(self, grid: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
        g, f = grid.alias("g"), found.alias("f")
        on = F.lit(True)
        for k in keys:
            on = on & F.col(f"g.`{k}`").eqNullSafe(F.col(f"f.`{k}`"))
        return g.join(f, on, "left").select(
            *[F.col(f"g.`{k}`") for k in keys], *[F.col(f"f.`{c}`") for c in found.columns if c not in keys])

    def _interval(self, win: Reach):
        match = TRAILING.fullmatch(win.range.strip())
        if not match:
            raise ValueError(f"window range {win.range!r} is not supported")
        return F.expr(f"INTERVAL {match.group(1)} {match.group(2)}")
