"""Bounded samples of labelled texts for fitting classifiers on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import with_text

#: A classifier is fitted on at most so many labelled texts, of at most so many characters in all.
MAX_ROWS, MAX_CHARS = 4_000, 16_000_000


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, usable: Column, max_rows: int = MAX_ROWS,
                    max_chars: int = MAX_CHARS) -> list[tuple[str, int]]:
    """(text, label) of labelled documents chosen by a hash of their ids, whole texts only, in a fixed order.

    ``usable`` says which label rows may be learnt from. Rows with a null id or label are left out; of
    several labels of one id the largest holds, of several texts the smallest. Ids are drawn first and then
    lengths, so the driver never holds more than the two bounds; texts that no longer fit are passed over.
    """
    drawn = (labels.where(usable & F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("_label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    wanted = {r.doc_id: r._label for r in drawn.collect()}
    texts = with_text(documents)
    spark = documents.sparkSession

    def rows_of(ids) -> DataFrame:
        small = spark.createDataFrame([(i,) for i in ids], "_id long")
        return texts.join(F.broadcast(small), F.col("doc_id") == F.col("_id"), "left_semi")  # at most max_rows ids

    sizes = {r.doc_id: r.n for r in rows_of(wanted).groupBy("doc_id").agg(F.max(F.length("text")).alias("n")).collect()}
    left, taken = max_chars, []
    for i in wanted:
        if i in sizes and sizes[i] <= left:
            left -= sizes[i]
            taken.append(i)
    found = {r.doc_id: r.text for r in rows_of(taken).groupBy("doc_id").agg(F.min("text").alias("text")).collect()}
    return [(found[i], int(wanted[i])) for i in taken]
