"""Change capture: merge, slowly changing dimensions and change feeds over snapshots.

File tables have no UPDATE or MERGE, so each job is a function from the old rows and the
changes to the new rows; publishing the result is left to ``sources.snapshots``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import OrderedGroups, global_numbers, null_safe


@dataclass(frozen=True)
class Clause:
    """One WHEN clause; expressions see the target as ``t`` and the source as ``s``.

    ``when`` is ``matched``, ``not_matched`` (insert side) or ``not_matched_by_source``.
    ``action`` is ``update``, ``delete`` or ``insert``. ``values`` maps target columns to SQL
    expressions; left out, an update or insert takes all same-named source columns.
    """

    when: str
    action: str
    condition: str = "true"
    values: Mapping[str, str] | None = None


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], clauses: Sequence[Clause]) -> DataFrame:
    """Target after the merge: the first clause whose condition holds acts on a row.

    A target row matched by several source rows is an error, raised while the plan runs.
    """
    copies = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("__copies"))
    counted, same = null_safe(source, copies, keys)  # a null key matches no target but is still inserted
    src = source.join(counted, same).drop(*[f"__key{i}" for i in range(len(keys))]).withColumn("__s", F.lit(True)).alias("s")
    tgt = target.withColumn("__t", F.lit(True)).alias("t")
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    sides = {
        "matched": F.col("__t").isNotNull() & F.col("__s").isNotNull(),
        "not_matched": F.col("__t").isNull(),
        "not_matched_by_source": F.col("__s").isNull(),
    }
    ambiguous = sides["matched"] & (F.col("__copies") > 1)
    which = F.when(ambiguous, F.raise_error(F.lit("merge: several source rows match one target row")).cast("int"))
    for i, c in enumerate(clauses):
        which = which.when(sides[c.when] & F.coalesce(F.expr(c.condition), F.lit(False)), F.lit(i))
    joined = tgt.join(src, on, "full").withColumn("__clause", which)
    gone = [i for i, c in enumerate(clauses) if c.action == "delete"]
    present = F.col("__t").isNotNull() | F.col("__clause").isNotNull()
    kept = joined.where(present & F.coalesce(~F.col("__clause").isin(gone), F.lit(True))) if gone else joined.where(present)
    out = []
    for name in target.columns:
        value = None
        for i, c in enumerate(clauses):
            if c.action == "delete":
                continue
            if c.values is None:
                new = F.col(f"s.{name}") if name in source.columns else None
            else:
                new = F.expr(c.values[name]) if name in c.values else None
            if new is None:
                if c.action == "update":
                    continue  # untouched column keeps its target value
                new = F.lit(None)
            cond = F.col("__clause") == i
            value = F.when(cond, new) if value is None else value.when(cond, new)
        old = F.col(f"t.{name}")
        out.append((old if value is None else value.otherwise(old)).alias(name))
    return kept.select(*out)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], delete_when: str | None = None) -> DataFrame:
    """The usual three clauses: delete, update all, insert all."""
    clauses = [] if delete_when is None else [Clause("matched", "delete", delete_when)]
    keep = "true" if delete_when is None else f"NOT coalesce({delete_when}, false)"
    return merge(target, source, keys, [*clauses, Clause("matched", "update"), Clause("not_matched", "insert", keep)])


def newest_per_key(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest row per key as a combinable aggregate: hot keys collapse before the shuffle.

    Ties on ``order`` go to the larger row, so the result is repeatable.
    """
    rest = [c for c in changes.columns if c not in keys]
    picked = changes.groupBy(*keys).agg(F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("__row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in changes.columns])


def scd1_state(changes: DataFrame, keys: Sequence[str], sequence: Sequence[str], delete_when: str,
               state: DataFrame | None = None, drop: Sequence[str] = (), ignore_nulls: bool = False) -> DataFrame:
    """Current row per key with its sequence and a ``__deleted`` tombstone flag.

    Passing the previous ``state`` folds a new batch in; tombstones stay, so a late event older
    than a delete cannot bring the row back. With ``ignore_nulls`` a null leaves the column's
    last value since the latest delete.
    """
    hidden = {*keys, *sequence, *drop}
    data = [c for c in changes.columns if c not in hidden]
    rows = changes.select(*keys, *sequence, *data, F.coalesce(F.expr(delete_when), F.lit(False)).alias("__deleted"))
    if state is not None:
        rows = rows.unionByName(state)
    if not ignore_nulls:
        return newest_per_key(rows, keys, [*sequence, "__deleted"])
    at = F.struct(*sequence)
    picked = rows.groupBy(*keys).agg(
        F.max(F.struct(*sequence, "__deleted")).alias("__top"),
        F.max(F.when(F.col("__deleted"), at)).alias("__cut"),
        *[F.max(F.when(~F.col("__deleted") & F.col(c).isNotNull(), F.struct(at.alias("at"), F.col(c).alias("v")))).alias(c)
          for c in data])
    alive = lambda c: F.col("__cut").isNull() | (F.col(f"{c}.at") > F.col("__cut"))
    return picked.select(
        *keys, *[F.col(f"__top.{c}").alias(c) for c in sequence],
        *[F.when(alive(c), F.col(f"{c}.v")).alias(c) for c in data], F.col("__top.__deleted").alias("__deleted"))


def scd1_rows(state: DataFrame, sequence: Sequence[str] = ()) -> DataFrame:
    """The table a reader sees: no tombstones, no bookkeeping columns."""
    return state.where(~F.col("__deleted")).drop("__deleted", *sequence)


def scd2(changes: DataFrame, keys: Sequence[str], sequence: Sequence[str], delete_when: str | None = None,
         track: Sequence[str] | None = None, drop: Sequence[str] = (),
         start: str = "__START_AT", end: str = "__END_AT") -> DataFrame:
    """One row per version; a change of tracked columns closes the previous version.

    Changes may arrive in any order; they are ordered by ``sequence`` (then by row hash on
    exact ties). A delete only closes. Versions with unchanged tracked columns are merged.
    """
    data = [c for c in changes.columns if c not in {*keys, *drop}]
    tracked = list(track) if track is not None else [c for c in data if c not in sequence]
    gone = F.lit(False) if delete_when is None else F.coalesce(F.expr(delete_when), F.lit(False))
    rows = changes.withColumns({
        "__gone": gone, "__tie": F.xxhash64(*changes.columns), "__state": F.struct(*tracked)})
    # the state is compared as values, so hash collisions cannot merge two versions
    groups = OrderedGroups(rows, keys, [*sequence, "__tie"]).lag({"__prev": "__state", "__prev_gone": "__gone"})
    first = F.col("__prev_gone").isNull()
    changed = F.when(F.col("__gone"), ~F.coalesce("__prev_gone", F.lit(True))).otherwise(
        first | F.col("__prev_gone") | ~F.col("__state").eqNullSafe(F.col("__prev")))
    closed = groups.where(changed).lead({end: sequence[0]}).where(~F.col("__gone")).result()
    return closed.withColumn(start, F.col(sequence[0])).select(
        *keys, *[c for c in data if c not in sequence], start, end)


def scd2_refresh(table: DataFrame, history: DataFrame, batch: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """New SCD2 table after a batch: only keys in the batch are rebuilt from their history."""
    touched = batch.select(*keys).distinct()
    redo = history.join(touched, list(keys), "left_semi").unionByName(batch)
    return table.join(touched, list(keys), "left_anti").unionByName(scd2(redo, keys, **options))


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str], version: int) -> DataFrame:
    """Row changes between two versions, with pre- and post-image of updates."""
    cols = old.columns
    left = old.select(*keys, F.struct(*cols).alias("__old"))
    right, on = null_safe(left, new.select(*keys, F.struct(*cols).alias("__new")), keys)
    joined = left.join(right, on, "full")
    image = lambda kind, side: F.struct(F.lit(kind).alias("kind"), F.col(side).alias("row"))
    events = (
        F.when(F.col("__old").isNull(), F.array(image("insert", "__new")))
        .when(F.col("__new").isNull(), F.array(image("delete", "__old")))
        .otherwise(F.array(image("update_preimage", "__old"), image("update_postimage", "__new")))
    )
    return (
        joined.where(~F.col("__old").eqNullSafe(F.col("__new"))).select(F.explode(events).alias("e"))
        .select("e.row.*", F.col("e.kind").alias("_change_type"), F.lit(version).cast("long").alias("_commit_version"))
    )


def apply_feed(target: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring a downstream copy up to date: newest change per key, pre-images skipped."""
    live = feed.where("_change_type <> 'update_preimage'")
    newest = newest_per_key(live, keys, ["_commit_version", "_change_type"])
    return upsert(target, newest, keys, delete_when="s._change_type = 'delete'")


def update_where(df: DataFrame, condition: str, values: Mapping[str, Column]) -> DataFrame:
    hit = F.coalesce(F.expr(condition), F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})


def delete_where(df: DataFrame, condition: str) -> DataFrame:
    """Rows for which the condition is not true (null keeps the row, as DELETE does)."""
    return df.where(~F.coalesce(F.expr(condition), F.lit(False)))


def add_identity(df: DataFrame, order: Sequence[str], name: str, start: int = 1, step: int = 1,
                 previous: DataFrame | None = None) -> DataFrame:
    """Identity column continuing after the largest value of ``previous``."""
    if previous is not None:
        last = previous.agg(F.max(name)).first()[0]
        start = start if last is None else last + step
    return global_numbers(df, order, name, start, step)


def constraint_report(df: DataFrame, checks: Mapping[str, str] = {}, not_null: Sequence[str] = (),
                      primary_key: Sequence[str] = (), foreign_keys: Mapping[str, tuple[str, DataFrame, str]] = {}) -> DataFrame:
    """Violations per constraint; a CHECK that is null holds, as in SQL."""
    rules = {f"check:{n}": F.count_if(~F.expr(e)) for n, e in checks.items()}
    rules |= {f"not_null:{c}": F.count_if(F.col(c).isNull()) for c in not_null}
    spark = df.sparkSession
    parts = []
    if rules:
        one = df.agg(*[v.alias(f"r{i}") for i, v in enumerate(rules.values())])
        pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"r{i}").alias("n")) for i, n in enumerate(rules)])
        parts.append(one.select(F.explode(pairs).alias("p")).select(F.col("p.name").alias("name"), F.col("p.n").alias("violations")))
    if primary_key:
        dup = df.groupBy(*primary_key).agg(F.count("*").alias("n")).where("n > 1")
        parts.append(dup.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations")).select(
            F.lit("primary_key:" + ",".join(primary_key)).alias("name"), "violations"))
    for name, (column, parent, parent_key) in foreign_keys.items():
        orphans = df.where(F.col(column).isNotNull()).select(F.col(column).alias("__k")).join(
            parent.select(F.col(parent_key).alias("__k")), "__k", "left_anti")
        parts.append(orphans.agg(F.count("*").alias("violations")).select(F.lit(f"foreign_key:{name}").alias("name"), "violations"))
    if not parts:
        return spark.createDataFrame([], "name string, violations long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
