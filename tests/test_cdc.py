import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import cdc
from millrace.sources.snapshots import VersionedTable


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def table(spark, data):
    return spark.createDataFrame(data, "id long, v string, n int")


def test_merge_clauses_in_order(spark):
    t = table(spark, [(1, "a", 1), (2, "b", 2), (3, "c", 3)])
    s = table(spark, [(2, "B", 20), (3, "C", 30), (4, "D", 40), (5, "E", 50)])
    out = cdc.merge(t, s, ["id"], [
        cdc.Clause("matched", "delete", "s.n > 25"), cdc.Clause("matched", "update", values={"v": "concat(t.v, s.v)"}),
        cdc.Clause("not_matched", "insert", "s.n < 45"), cdc.Clause("not_matched_by_source", "update", values={"n": "t.n - 1"})])
    assert rows(out, "id", "v", "n") == [(1, "a", 0), (2, "bB", 2), (4, "D", 40)]


def test_merge_refuses_ambiguous_source(spark):
    t, s = table(spark, [(1, "a", 1)]), table(spark, [(1, "x", 1), (1, "y", 2)])
    with pytest.raises(Exception, match="several source rows"):
        cdc.upsert(t, s, ["id"]).collect()
    # duplicates that match nothing are plain inserts
    assert cdc.upsert(t, table(spark, [(9, "x", 1), (9, "y", 2)]), ["id"]).count() == 3


def test_null_keys_are_inserted_never_matched(spark):
    t, s = table(spark, [(None, "old", 1), (1, "a", 1)]), table(spark, [(None, "new", 2)])
    assert rows(cdc.upsert(t, s, ["id"]), "id", "v") == [(1, "a"), (None, "new"), (None, "old")]


def test_bill_of_materials_to_the_end(spark):
    from millrace.operators.aggregates import rollup_components

    bom = spark.createDataFrame([(1, 2, 3), (1, 3, 1), (2, 3, 2), (3, 4, 10)], "parent long, child long, qty long")
    need = spark.createDataFrame([(1, 5), (3, 1)], "part long, need long")
    assert rows(rollup_components(need, bom), "part", "total_need") == [(1, 5), (2, 15), (3, 36), (4, 360)]


def test_merge_is_idempotent(spark):
    t, s = table(spark, [(1, "a", 1), (2, "b", 2)]), table(spark, [(2, "B", 3), (3, "c", 4)])
    once = cdc.upsert(t, s, ["id"])
    assert rows(cdc.upsert(once, s, ["id"]), "id", "v", "n") == rows(once, "id", "v", "n")


EVENTS = st.lists(st.tuples(st.integers(1, 3), st.integers(1, 8), st.sampled_from(["U", "D"]), st.sampled_from(["a", "b", None])), min_size=1, max_size=14,
                  unique_by=lambda e: (e[0], e[1]))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(events=EVENTS, cut=st.integers(0, 14))
def test_scd_against_replay(spark, events, cut):
    """Any arrival order and batching gives what replaying in sequence order gives."""
    shape = "id long, seq long, op string, v string"
    opts = dict(keys=["id"], sequence=["seq"], delete_when="op = 'D'", drop=["op"])
    first, second = spark.createDataFrame(events[:cut], shape), spark.createDataFrame(events[cut:], shape)
    state = cdc.scd1_state(second, state=cdc.scd1_state(first, **opts), **opts)
    want, history = {}, {}
    for k, seq, op, v in sorted(events, key=lambda e: (e[0], e[1])):
        log = history.setdefault(k, [])
        if op == "D":
            want.pop(k, None)
            if log and log[-1][2] is None:
                log[-1] = (*log[-1][:2], seq)
        else:
            want[k] = v
            if log and log[-1][2] is None:
                if log[-1][0] == v:
                    continue
                log[-1] = (*log[-1][:2], seq)
            log.append((v, seq, None))
    assert rows(cdc.scd1_rows(state, ["seq"]), "id", "v") == sorted(((k, v) for k, v in want.items()), key=str)
    got = cdc.scd2(spark.createDataFrame(events, shape), ["id"], ["seq"], "op = 'D'", drop=["op"])
    assert rows(got, "id", "v", "__START_AT", "__END_AT") == sorted(((k, *x) for k, log in history.items() for x in log), key=str)


def test_scd1_ignore_nulls_stops_at_delete(spark):
    ev = spark.createDataFrame([(1, 1, "U", "a", "x"), (1, 2, "D", None, None), (1, 3, "U", "b", None), (2, 1, "U", "a", "x"), (2, 2, "U", None, "y")],
                               "id long, seq long, op string, v string, w string")
    got = cdc.scd1_state(ev, ["id"], ["seq"], "op = 'D'", drop=["op"], ignore_nulls=True)
    assert rows(cdc.scd1_rows(got, ["seq"]), "id", "v", "w") == [(1, "b", None), (2, "a", "y")]


def test_scd2_refresh_rebuilds_touched_keys_only(spark):
    shape, opts = "id long, seq long, op string, v string", dict(sequence=["seq"], delete_when="op = 'D'", drop=["op"])
    old = spark.createDataFrame([(1, 1, "U", "a"), (2, 1, "U", "a"), (1, 5, "U", "c")], shape)
    late = spark.createDataFrame([(1, 3, "U", "b")], shape)
    got = cdc.scd2_refresh(cdc.scd2(old, ["id"], **opts), old, late, ["id"], **opts)
    assert rows(got, "id", "v", "__START_AT", "__END_AT") == rows(cdc.scd2(old.unionByName(late), ["id"], **opts), "id", "v", "__START_AT", "__END_AT")


def test_change_feed_round_trip(spark):
    a, b = table(spark, [(1, "a", 1), (2, None, 2), (3, "c", 3)]), table(spark, [(1, "a", 1), (2, "b", 2), (4, "d", 4)])
    feed = cdc.change_feed(a, b, ["id"], 7)
    assert [r[0] for r in rows(feed, "_change_type")] == ["delete", "insert", "update_postimage", "update_preimage"]
    assert rows(cdc.apply_feed(a, feed, ["id"]), "id", "v", "n") == rows(b, "id", "v", "n")


def test_delete_where_keeps_nulls(spark):
    t = table(spark, [(1, None, 1), (2, "x", 2)])
    assert rows(cdc.delete_where(t, "v = 'x'"), "id") == [(1,)]


def test_identity_continues(spark):
    prev = spark.createDataFrame([(100,), (110,)], "id long")
    got = cdc.add_identity(spark.range(3).withColumnRenamed("id", "k"), ["k"], "id", step=10, previous=prev)
    assert rows(got, "k", "id") == [(0, 120), (1, 130), (2, 140)]


def test_versions(spark, tmp_path):
    t = VersionedTable(spark, f"{tmp_path}/t", ["id"], 4)
    t.publish(table(spark, [(i, "a", i) for i in range(20)]), "create", batch="b0")
    t.publish(table(spark, []), "create", batch="b0")  # a repeated batch changes nothing
    assert t.latest() == 0
    before = t._files(0)
    t.rewrite(table(spark, [(3, "z", 0)]), lambda old, new: cdc.upsert(old, new, ["id"]), batch="b1")
    t.rewrite(table(spark, [(3, "y", 0)]), lambda old, new: cdc.upsert(old, new, ["id"]), batch="b1")
    assert rows(t.read().where("v <> 'a'"), "id", "v") == [(3, "z")] and t.read().count() == 20
    assert sum(before[b] != p for b, p in t._files(1).items()) == 1  # one bucket rewritten
    assert t.read(0).where("id = 3").first()["v"] == "a"
    t.restore(0)
    assert t.read().where("v <> 'a'").isEmpty()
    hist = {r["version"]: (r["operation"], r["rows"]) for r in t.history().collect()}
    assert hist == {0: ("create", 20), 1: ("merge", 20), 2: ("restore 0", 20)}
    assert t.version_at(dt.datetime.now() + dt.timedelta(days=1)) == 2
    copy = t.clone(f"{tmp_path}/deep")
    light = t.clone(f"{tmp_path}/light", deep=False)
    assert copy.read().count() == light.read().count() == 20
    removed = t.vacuum(dt.datetime.now() + dt.timedelta(days=1))
    assert removed == 1 and t.read().count() == 20
    light.vacuum(dt.datetime.now() + dt.timedelta(days=1))
    assert light.read().count() == 20


def test_empty_and_widened_versions(spark, tmp_path):
    t = VersionedTable(spark, f"{tmp_path}/t")
    t.publish(table(spark, []), "create")
    assert t.read().count() == 0
    t.append(table(spark, [(1, "a", 1)]))
    t.append(table(spark, [(2, "b", 2)]).withColumn("extra", F.lit(True)))
    assert rows(t.read(), "id", "extra") == [(1, None), (2, True)]
    assert t.compact(["id"], 1) == 3 and t.read().count() == 2


def test_constraint_report(spark):
    child = spark.createDataFrame([(1, 10), (1, None), (2, 99)], "id long, parent long")
    got = cdc.constraint_report(child, {"small": "parent < 50"}, ["parent"], ["id"], {"fk": ("parent", spark.createDataFrame([(10,)], "p long"), "p")})
    assert dict(map(tuple, got.collect())) == {"check:small": 1, "not_null:parent": 1, "primary_key:id": 1, "foreign_key:fk": 1}


def test_change_feed_matches_null_keys(spark):
    old = spark.createDataFrame([(None, 1), (1, 1), (2, 5)], "id int, v int")
    new = spark.createDataFrame([(None, 1), (1, 2)], "id int, v int")
    rows = cdc.change_feed(old, new, ["id"], 1).collect()
    assert sorted((r.id, r.v, r._change_type) for r in rows) == [(1, 1, "update_preimage"), (1, 2, "update_postimage"), (2, 5, "delete")]


def test_bill_of_any_depth_and_circles(spark):
    import pytest

    from millrace.operators.aggregates import rollup_components

    demand = spark.createDataFrame([(0, 1)], "part long, need long")
    chain = spark.createDataFrame([(i, i + 1, 1) for i in range(7)], "parent long, child long, qty long")
    assert {(r.part, r.deepest) for r in rollup_components(demand, chain).collect()} == {(i, i) for i in range(8)}
    circle = spark.createDataFrame([(0, 1, 1), (1, 0, 1)], "parent long, child long, qty long")
    with pytest.raises(ValueError):
        rollup_components(demand, circle)
