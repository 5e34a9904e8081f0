"""Preparing, training, scoring and judging models with Spark ML and aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.ordered import OrderedGroups
from millrace.session import materialize, work_dir


def prepare(numbers: Sequence[str], labels: Sequence[str] = ()) -> Pipeline:
    """Mean-impute and standardise numbers, one-hot encode labels, assemble ``features``."""
    filled = [f"{c}_filled" for c in numbers]
    stages = [
        Imputer(inputCols=list(numbers), outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="raw_numbers"),
        StandardScaler(inputCol="raw_numbers", outputCol="numbers", withMean=True),
    ]
    parts = ["numbers"]
    if labels:
        codes, hots = [f"{c}_code" for c in labels], [f"{c}_hot" for c in labels]
        stages += [StringIndexer(inputCols=list(labels), outputCols=codes, handleInvalid="keep"),
                   OneHotEncoder(inputCols=codes, outputCols=hots)]
        parts += hots
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=parts, outputCol="features")])


def balanced(rows: DataFrame, label: str) -> DataFrame:
    """Rows with a ``weight`` that makes label 1 weigh as much as label 0 (all 1 where a label is missing)."""
    n, ones = rows.agg(F.count("*"), F.sum(label)).first()
    up = (n - ones) / ones if ones and n > ones else 1.0
    return rows.withColumn("weight", F.when(F.col(label) == 1, F.lit(float(up))).otherwise(1.0))


def fit_classifier(rows: DataFrame, numbers: Sequence[str], labels: Sequence[str], label: str = "label", iterations: int = 100) -> PipelineModel:
    """Logistic regression with weights that balance the two classes, until it converges or for so many iterations."""
    weighted = balanced(rows, label)
    head = LogisticRegression(labelCol=label, weightCol="weight", maxIter=iterations, regParam=0.01)
    fitted = Pipeline(stages=[*prepare(numbers, labels).getStages(), head]).fit(weighted)
    return publish_model(rows.sparkSession, fitted, "classifier")


def fit_boosted(rows: DataFrame, numbers: Sequence[str], labels: Sequence[str], choosing: str, label: str = "label",
                rounds: int = 40, depth: int = 3, step: float = 0.1, seed: int = 1) -> PipelineModel:
    """Gradient-boosted trees with weights that balance the classes; rows where ``choosing`` is true say after how many trees to stop.

    Those rows take no part in growing the trees, nor in the means, scales and codes of the features. Nulls in
    numbers become the mean; rows with a null label are left out; labels are 0 and 1.
    """
    known = rows.where(F.col(label).isNotNull()).withColumn(choosing, F.coalesce(choosing, F.lit(False)))
    known = materialize(known, "boosting")
    shape = prepare(numbers, labels).fit(known.where(~F.col(choosing)))
    head = GBTClassifier(labelCol=label, weightCol="weight", validationIndicatorCol=choosing, maxIter=rounds, maxDepth=depth, stepSize=step, validationTol=0.0, seed=seed)
    trees = head.fit(shape.transform(balanced(known, label)))
    return publish_model(rows.sparkSession, PipelineModel([*shape.stages, trees]), "boosted")


def publish_model(spark: SparkSession, model: PipelineModel, label: str) -> PipelineModel:
    """Save a fitted model to the shared folder and load it back.

    A loaded model carries no training summary; the summary holds the session, which cannot
    be shipped to tasks once the session has observed metrics.
    """
    path = work_dir(spark, f"model-{label}")
    model.write().save(path)
    return PipelineModel.load(path)


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).withColumn("probability", vector_to_array("probability")[1])


def linear_weights(rows: DataFrame, columns: Sequence[str], label: str = "label", iterations: int = 100) -> tuple[list[float], float]:
    """Coefficients of a logistic regression; a few numbers per column."""
    vec = VectorAssembler(inputCols=list(columns), outputCol="v").transform(rows)
    model = LogisticRegression(featuresCol="v", labelCol=label, maxIter=iterations, regParam=0.01).fit(vec)
    return [float(x) for x in model.coefficients], float(model.intercept)


def linear_score(weights: Sequence[float], intercept: float):
    """Vectorised scorer; the weights travel once per task inside the function."""

    @F.pandas_udf("double")
    def run(*columns: pd.Series) -> pd.Series:
        z = sum((c.to_numpy(dtype=float) * w for c, w in zip(columns, weights)), np.full(len(columns[0]), intercept))
        return pd.Series(1.0 / (1.0 + np.exp(-z)))

    return run


def confusion(rows: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    cell = lambda a, b: F.count_if((F.col(label) == a) & (F.col(prediction) == b))
    counts = rows.groupBy(*by).agg(cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(0, 0).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns({
        "accuracy": F.try_divide(tp + tn, tp + fp + fn + tn), "precision": F.try_divide(tp, tp + fp),
        "recall": F.try_divide(tp, tp + fn), "f1": F.try_divide(2 * tp, 2 * tp + fp + fn)})


def auc(rows: DataFrame, label: str, score: str) -> DataFrame:
    """One row, ``auc``: the chance that a row of label 1 scores above one of label 0, ties counting half; null without both.

    Equal scores are counted first, so only distinct scores are ordered, in chunks, and any number of rows may share
    one. A positive row beats the negatives of all lower scores and half of those that tie. Rows with a null are left out.
    """
    counts = rows.where(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("yes"), F.count_if(F.col(label) == 0).alias("no"))
    ran = OrderedGroups(materialize(counts, "scores"), [], ["score"]).running({"upto": ("sum", F.col("no"))}).result()
    beaten = F.sum(F.col("yes") * (F.col("upto") - F.col("no") / 2))
    return ran.agg(F.try_divide(beaten, F.sum("yes") * F.sum("no")).alias("auc"))


def business_value(rows: DataFrame, label: str, models: Sequence[str], worth: Mapping[tuple[int, int], float]) -> DataFrame:
    """Total worth of each model's decisions; ``worth`` maps (label, prediction) to money."""
    value = lambda m: sum(
        (F.count_if((F.col(label) == a) & (F.col(m) == b)) * w for (a, b), w in worth.items()), F.lit(0.0))
    wide = rows.agg(F.count("*").alias("n"), *[value(m).alias(m) for m in models])
    return wide.unpivot(["n"], list(models), "model", "value").select("model", "n", F.col("value").cast("double").alias("value"))


def set_scores(predicted: Column, truth: Column) -> tuple[Column, Column]:
    hits = F.size(F.array_intersect(predicted, truth))
    return F.try_divide(hits, F.size(predicted)), F.try_divide(hits, F.size(truth))


def parity_gap(rows: DataFrame, group: str, prediction: str) -> DataFrame:
    """Largest difference of positive rates between groups."""
    rates = rows.groupBy(group).agg(F.avg(prediction).alias("rate"))
    return rates.agg((F.max("rate") - F.min("rate")).alias("parity_gap"), F.max_by(group, "rate").alias("highest"), F.count("*").alias("groups"))
