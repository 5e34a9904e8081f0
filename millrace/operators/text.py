"""Document and conversation jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import words
from millrace.operators.learning import publish_model

SEGMENT_TURNS = 1000


def embed(df: DataFrame, text: str, dim: int = 256) -> DataFrame:
    """Unit-length hashed TF-IDF vectors in column ``features``."""
    rows = df.withColumn("__tokens", words(F.lower(text)))
    stages = [HashingTF(inputCol="__tokens", outputCol="__tf", numFeatures=dim), IDF(inputCol="__tf", outputCol="__idf"),
              Normalizer(inputCol="__idf", outputCol="features")]
    return Pipeline(stages=stages).fit(rows).transform(rows).drop("__tokens", "__tf", "__idf")


def embed_with(df: DataFrame, text: str, load: Callable[[], Callable[[list[str]], list[list[float]]]], name: str = "vector") -> DataFrame:
    """Vectors from an outside model; ``load`` runs once per task and returns the encoder."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            yield pd.Series(model(batch.tolist()))

    return df.withColumn(name, encode(text))


def train_text_classifier(rows: DataFrame, text: str, label: str, dim: int = 4096, iterations: int = 100):
    """Logistic regression on hashed TF-IDF; returns a function scoring any rows."""
    fit_rows = rows.withColumn("__tokens", words(F.lower(text)))
    model = Pipeline(stages=[
        HashingTF(inputCol="__tokens", outputCol="__tf", numFeatures=dim), IDF(inputCol="__tf", outputCol="__x"),
        LogisticRegression(featuresCol="__x", labelCol=label, maxIter=iterations, regParam=0.01)]).fit(fit_rows)
    model = publish_model(rows.sparkSession, model, "text")
    keep = ["prediction"]
    return lambda df: model.transform(df.withColumn("__tokens", words(F.lower(text)))).select(*df.columns, *keep)


def annotate(df: DataFrame, key: str, text: str, model: Callable[[str], str], shape: str) -> DataFrame:
    """Run a text → JSON-array model and return one row per item, joined to its source row.

    ``shape`` is the SQL type of one item. Rows whose answer does not parse give no items.
    """

    @F.pandas_udf(T.StringType())
    def answer(batch: pd.Series) -> pd.Series:
        return batch.map(model)

    parsed = df.withColumn("__items", F.from_json(answer(text), f"array<{shape}>"))
    return parsed.withColumn("__item", F.explode("__items")).select(*df.columns, "__item.*")


def with_last_turn(turns: DataFrame) -> DataFrame:
    """Turns with the number and role of the last turn of their conversation (a combinable maximum, joined back)."""
    last = turns.groupBy("conv_id").agg(F.max("turn").alias("last_turn"), F.max_by("role", "turn").alias("last_role"))
    return turns.join(last, "conv_id")


def conversation_segments(turns: DataFrame, size: int = SEGMENT_TURNS) -> DataFrame:
    """Ordered turns per conversation as an array, in segments of at most ``size`` turns.

    Segments bound the row a long conversation would become; every turn is kept. Whether a conversation
    is used, and which of its turns, is for :func:`with_last_turn` to say before it is cut.
    """
    seg = F.floor(F.col("turn") / size).alias("segment")
    return turns.groupBy("conv_id", seg).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
