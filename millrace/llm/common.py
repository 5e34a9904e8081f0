"""Helpers shared by the corpus operators: clean inputs, Arrow slices, state kept per Python worker."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows that a mapper holds as Python objects at once.
SLICE_ROWS = 512


def with_text(documents: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (null read as empty) and the named columns; any other column is left behind."""
    return documents.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def in_fold(doc_id: str | Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold`` on division by ``folds``; false for a null id."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def map_slices(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | dict], schema: str, rows: int = SLICE_ROWS) -> DataFrame:
    """``mapInArrow`` over slices of bounded row count; ``work`` gives the columns of ``schema`` for a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                made = work(batch.slice(at, rows))
                yield made if isinstance(made, pa.RecordBatch) else pa.RecordBatch.from_pydict(made)

    return df.mapInArrow(run, schema)


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a string column without decoding it."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def worker_state(key: tuple, make: Callable[[], object]):
    """An object made once per Python worker process and kept for its later tasks.

    Functions travel by value, so their own globals start anew with every task. Workers live on through the stages of
    a job, so only the object used last is kept: the memory of a stage goes when the next one begins.
    """
    store = sys.modules.setdefault("_millrace_worker_state", types.ModuleType("_millrace_worker_state")).__dict__.setdefault("kept", {})
    if key not in store:
        store.clear()  # before the new one is made
        store[key] = make()
    return store[key]
