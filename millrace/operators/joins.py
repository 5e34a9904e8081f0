"""Joins Spark has no operator for: as-of, validity interval, time overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import OrderedGroups


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
              columns: Sequence[str], tiebreak: Sequence[str] = (), lookback: Column | None = None) -> DataFrame:
    """Each left row with the last right row of its key whose time is not later.

    Both sides are stacked and ordered together (right rows first at equal times), so the
    join is one shuffle and one sort on the key, with no pairs produced. ``lookback`` is an
    interval that drops matches older than left time minus interval. ``tiebreak`` names right
    columns that order right rows of equal time.
    """
    lcols = [c for c in left.columns]
    ties = [f"__tie{i}" for i in range(len(tiebreak))]
    carried = [F.col(right_ts).alias("ts"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]]
    known = F.col(right_ts).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()  # null keys and times match nothing
    facts = right.where(known).select(
        *keys, F.col(right_ts).alias("__ts"), F.lit(0).alias("__side"),
        *[F.col(t).alias(n) for t, n in zip(tiebreak, ties)], F.struct(*carried).alias("__fact"),
    )
    probes = left.select(
        *keys, F.col(left_ts).alias("__ts"), F.lit(1).alias("__side"),
        F.struct(*lcols).alias("__row"),
    )
    both = facts.unionByName(probes, allowMissingColumns=True)
    both = OrderedGroups(both, keys, ["__ts", "__side", *ties]).last_value({"__hit": F.col("__fact")}).result()
    hit = both.where("__side = 1")
    keep = F.lit(True) if lookback is None else F.col("__hit.ts") >= F.col("__ts") - lookback
    return hit.select(
        "__row.*",
        F.when(keep, F.col("__hit.ts")).alias(f"matched_{right_ts}"),
        *[F.when(keep, F.col(f"__hit.c{i}")).alias(c) for i, c in enumerate(columns)],
    )


def close_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Effective-dated rows become ``[start, end)``; the newest stays open (null end)."""
    return OrderedGroups(df, keys, [start, *tiebreak]).lead({end: start}).result()


def interval_join(facts: DataFrame, spans: DataFrame, keys: Sequence[str], at: str, start: str, end: str,
                  bucket_seconds: int, how: str = "inner") -> DataFrame:
    """Fact time inside ``[start, end)`` of spans of the same key; a null end is open.

    Spans are exploded over fixed-width time buckets and joined by equality on
    (key, bucket), so long histories of one key spread over tasks. A fact lies in one bucket
    only, hence matches are never duplicated. Open ends stop at the last fact bucket.
    """
    bucket = lambda c: F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / bucket_seconds)
    # one subquery gives both ends of the facts' time range
    ends = facts.select(F.struct(F.min(bucket(at)).alias("lo"), F.max(bucket(at)).alias("hi"))).scalar()
    lo, hi = ends.getField("lo"), ends.getField("hi")
    first_bucket = F.greatest(bucket(start), lo)
    last_bucket = F.least(F.coalesce(bucket(end), hi), hi)
    cut = (
        spans.where(F.col(end).isNull() | (F.col(start) < F.col(end)))
        .withColumn("__from", first_bucket).withColumn("__to", last_bucket)
        .where("__from <= __to")
        .withColumn("__bucket", F.explode(F.sequence("__from", "__to")))
        .drop("__from", "__to")
    )
    f = facts.withColumn("__bucket", bucket(at)).alias("f")
    s = cut.alias("s")
    on = F.col("f.__bucket") == F.col("s.__bucket")
    for k in keys:
        on = on & (F.col(f"f.{k}") == F.col(f"s.{k}"))
    on = on & (F.col(f"f.{at}") >= F.col(f"s.{start}"))
    on = on & (F.col(f"s.{end}").isNull() | (F.col(f"f.{at}") < F.col(f"s.{end}")))
    taken = set(facts.columns)
    extra = [F.col(f"s.{c}") for c in spans.columns if c not in taken]
    return f.join(s, on, how).select(*[F.col(f"f.{c}") for c in facts.columns], *extra)


def overlap_join(left: DataFrame, right: DataFrame, left_span: tuple[str, str], right_span: tuple[str, str],
                 bucket_seconds: int, keys: Sequence[str] = ()) -> DataFrame:
    """Pairs whose closed spans overlap, by equality on shared time buckets.

    A pair may share several buckets; it is kept only in the first bucket both have, so no
    de-duplication shuffle is needed. Column names of the two sides must differ.
    """
    bucket = lambda c: F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / bucket_seconds)

    def cut(df: DataFrame, span: tuple[str, str], mark: str) -> DataFrame:
        return (
            df.where(F.col(span[0]) <= F.col(span[1]))
            .withColumn(f"__first_{mark}", bucket(span[0]))
            .withColumn("__bucket", F.explode(F.sequence(bucket(span[0]), bucket(span[1]))))
        )

    on = ["__bucket", *keys]
    joined = cut(left, left_span, "l").join(cut(right, right_span, "r"), on)
    return joined.where(
        (F.col(left_span[0]) <= F.col(right_span[1])) & (F.col(right_span[0]) <= F.col(left_span[1]))
        & (F.col("__bucket") == F.greatest("__first_l", "__first_r"))
    ).drop("__bucket", "__first_l", "__first_r")
