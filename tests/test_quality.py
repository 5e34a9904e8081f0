import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import quality as q
from millrace.operators.rules import add_rule_columns
from millrace.plans.metric_view import MetricView
from millrace.plans.pipeline import Pipeline

USERS = [(1, "a@x"), (0, "zero@x"), (None, "none@x"), (2, None), (3, "c@x")]
RULES = [q.Rule("valid_id", "id IS NOT NULL AND id > 0", "drop"), q.Rule("has_mail", "email LIKE '%@%'", "warn")]


@pytest.fixture
def users(spark):
    return spark.createDataFrame(USERS, "id long, email string")


def test_null_counts_as_failed(users):
    counts = {r["rule"]: (r["passed"], r["failed"], r["dropped"]) for r in q.rule_counts(users, RULES, "users").collect()}
    assert counts == {"valid_id": (3, 2, 2), "has_mail": (4, 1, 0)}


def test_quarantine_is_the_complement(users):
    good, bad = q.quarantine(users, RULES)
    assert good.count() + bad.count() == users.count()
    assert sorted(r["email"] or "" for r in good.collect()) == ["a@x", "c@x"]
    assert {tuple(r["failed_rules"]) for r in bad.collect()} == {("valid_id",), ("has_mail",)}


def build(spark, users, rules):
    p = Pipeline(spark)

    @p.view()
    def users_raw():
        return users

    @p.table(rules=rules)
    def users_clean(users_raw):
        return users_raw

    @p.view(name="user_count")
    def count(users_clean):
        return users_clean.agg(F.count("*").alias("n"))

    return p


def test_refresh_order_events_and_lineage(spark, users):
    p = build(spark, users, RULES)
    run = p.refresh()
    assert run["user_count"].first()["n"] == 3
    events = {(r["dataset"], r["rule"]): (r["passed"], r["failed"], r["dropped"]) for r in run.events().collect()}
    assert events == {("users_clean", "valid_id"): (3, 2, 2), ("users_clean", "has_mail"): (4, 1, 0)}
    assert {(r["input"], r["output"]) for r in p.lineage().collect()} == {("users_raw", "users_clean"), ("users_clean", "user_count")}


def test_fail_rule_keeps_the_published_version(spark, users, tmp_path):
    p = build(spark, users.where("id > 0 AND email IS NOT NULL"), [q.Rule("mail", "email IS NOT NULL", "fail")])
    p.root = str(tmp_path)
    assert p.refresh()["user_count"].first()["n"] == 2
    with pytest.raises(q.QualityError, match="mail"):
        p.refresh(replace={"users_raw": users})  # a test profile swapped in for the source
    from millrace.sources.snapshots import VersionedTable

    assert VersionedTable(spark, f"{tmp_path}/users_clean").latest() == 0
    with pytest.raises(Exception, match="breaks mail"):
        q.fail_if_broken(users, [q.Rule("mail", "email IS NOT NULL", "fail")], "users").collect()


def test_bad_graphs_are_named(spark, users):
    p = build(spark, users, [])
    p.table(name="lost")(lambda nowhere: nowhere)
    with pytest.raises(ValueError, match="nowhere"):
        p.order()


def test_contract(spark, users):
    shape = T.StructType([T.StructField("email", T.StringType(), False, {"comment": "address"}), T.StructField("id", T.LongType())])
    out = q.conform(users.where("email IS NOT NULL"), shape)
    assert out.columns == ["email", "id"] and out.schema["email"].metadata["comment"] == "address" and out.count() == 4
    with pytest.raises(Exception, match="email is null"):
        q.conform(users, shape).collect()


def test_rule_columns_name_the_bad_rule(spark, users):
    rules = spark.createDataFrame([(1, "x", "id + 1", True), (2, "y", "nope(", True)], "rule_id long, adds string, formula string, in_use boolean")
    with pytest.raises(ValueError, match="rule 2"):
        add_rule_columns(users, rules)


def test_rules_are_ordered_by_need(spark, users):
    made = lambda rows: spark.createDataFrame(rows, "rule_id long, adds string, formula string, in_use boolean")
    out = add_rule_columns(users, made([(1, "b", "a + 1", True), (2, "a", "id * 2", True), (3, "c", "a + b", True), (4, "d", "nope", False)]))
    assert all((r.a, r.b, r.c) == (r.id * 2, r.id * 2 + 1, r.id * 4 + 1) for r in out.where("id IS NOT NULL").collect())
    with pytest.raises(ValueError, match="need each other: a, b"):
        add_rule_columns(users, made([(1, "b", "a + 1", True), (2, "a", "b * 2", True)]))


def test_auc_counts_ties_half(spark):
    from millrace.operators.learning import auc

    rows = [(1, 3.0), (0, 3.0), (1, 5.0), (0, 1.0), (0, 5.0), (1, 5.0), (None, 2.0), (1, None)]
    yes, no = [s for y, s in rows if y == 1 and s], [s for y, s in rows if y == 0]
    want = sum((a > b) + (a == b) / 2 for a in yes for b in no) / (len(yes) * len(no))
    table = spark.createDataFrame(rows, "y int, s double")
    assert auc(table, "y", "s").first().auc == pytest.approx(want)
    assert auc(table.where("y = 1"), "y", "s").first().auc is None


def test_metric_view_grain_and_windows(spark):
    rows = spark.createDataFrame([("2024-01", "a", 1, 10.0), ("2024-01", "b", 2, 5.0), ("2024-02", "a", 1, 7.0), ("2024-04", "a", 3, 1.0)], "m string, g string, u int, x double")
    rows = rows.withColumn("m", F.to_timestamp(F.concat("m", F.lit("-01"))))
    view = MetricView.from_yaml("""
source: facts
dimensions: [{name: M, expr: m}, {name: G, expr: g}]
measures:
  - {name: Total, expr: sum(x)}
  - {name: Users, expr: count(DISTINCT u)}
  - {name: Per user, expr: MEASURE(Total) / MEASURE(Users)}
  - {name: Previous, expr: sum(x), window: [{order: M, range: trailing 1 month}]}
  - {name: Now, expr: sum(x), window: [{order: M, range: current}]}
  - {name: Recent users, expr: count(DISTINCT u), window: [{order: M, range: trailing 2 month}]}
  - {name: Recent mean, expr: avg(x), window: [{order: M, range: trailing 2 month}]}
""")
    ask = lambda *a: view.query(lambda n: rows, *a)
    assert [tuple(r) for r in ask([], ["Per user", "Now", "Previous"]).collect()] == [(23 / 3, 1.0, None)]
    got = {(r["M"].month, r["G"]): (r["Previous"], r["Recent users"], r["Recent mean"]) for r in ask(["M", "G"], ["Previous", "Recent users", "Recent mean"]).collect()}
    assert got == {(1, "a"): (None, None, None), (1, "b"): (None, None, None), (2, "a"): (10.0, 1, 10.0), (4, "a"): (None, 1, 7.0)}
    with pytest.raises(ValueError, match="unknown measure"):
        ask([], ["Nope"])
