"""Boosted trees on a fixture whose label is an interaction, and text lists per key."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import learning
from millrace.operators.aggregates import text_lists


@pytest.fixture(scope="module")
def crossed(spark):
    """Label 1 (a quarter of the rows) where exactly one of two numbers is large, with some noise; nulls in every column."""
    rng = random.Random(4)
    rows = []
    for i in range(1500):
        a, b = rng.random(), rng.random()
        label = float((a > 0.7) != (b > 0.85)) if rng.random() < 0.96 else float(rng.random() < 0.5)
        rows.append((i, None if i % 41 == 0 else a, None if i % 43 == 0 else b, rng.choice(["x", "y", None]), None if i % 97 == 0 else label))
    return spark.createDataFrame(rows, "id long, a double, b double, kind string, label double").withColumns(
        {"held_out": F.col("id") % 5 == 0, "choosing": F.when(F.col("id") % 5 == 1, True).when(F.col("id") % 5 == 2, False)})


def test_boosted_trees_see_the_interaction(spark, crossed):
    seen = crossed.where("not held_out")
    boosted = learning.fit_boosted(seen, ["a", "b"], ["kind"], "choosing")
    straight = learning.fit_classifier(seen.where("label IS NOT NULL"), ["a", "b"], ["kind"])
    marks = []
    for model in (boosted, straight):
        scored = learning.score(model, crossed)
        assert scored.count() == 1500 and scored.where("probability IS NULL OR probability < 0 OR probability > 1").isEmpty()
        marks.append(learning.auc(scored.where("held_out"), "label", "probability").first().auc)
    assert marks[0] > 0.9 and marks[0] > marks[1] + 0.1
    assert 1 <= boosted.stages[-1].getNumTrees <= 40
    counts = learning.confusion(learning.score(boosted, crossed).where("held_out AND label IS NOT NULL"), "label", "prediction").first()
    assert counts["recall"] > 0.75  # the rarer class is not given up


def test_balanced_weights(spark):
    rows = spark.createDataFrame([(1.0,), (0.0,), (0.0,), (0.0,), (None,)], "label double")
    weights = {r["label"]: r["weight"] for r in learning.balanced(rows.where("label IS NOT NULL"), "label").collect()}
    assert weights == {1.0: 3.0, 0.0: 1.0}
    for part in ("label = 0", "label = 1", "label > 5"):
        assert learning.balanced(rows.where(part), "label").where("weight <> 1").isEmpty()


def test_text_lists_lose_nothing(spark, split_all):
    rows = [("hot", i, None if i % 10 == 0 else "" if i % 7 == 0 else f"t{i}") for i in range(500)] + [(None, 1, "n"), ("one", 2, "o"), ("none", 3, None)]
    df = spark.createDataFrame(rows, "k string, at long, t string").repartition(3)
    got = {(r["k"], r["segment"]): (r["texts"], r["all"]) for r in text_lists(df, ["k"], ["at"], "t", "all", "|", 64).collect()}
    hot = [t for k, _, t in rows if k == "hot" and t is not None]
    want = {("hot", i // 64): (len(hot[i:i + 64]), "|".join(hot[i:i + 64])) for i in range(0, len(hot), 64)}
    assert got == {**want, (None, 0): (1, "n"), ("one", 0): (1, "o")}
    assert text_lists(df.where("at < 0"), ["k"], ["at"], "t", "all").isEmpty()
