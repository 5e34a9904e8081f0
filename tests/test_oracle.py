"""Every registered query against its DuckDB twin at the smallest scale."""

import glob

import pytest

import __spark_entry__ as entry
from millrace.queries.registry import QUERIES
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"
KEYS = sorted(QUERIES)

pytestmark = pytest.mark.skipif(not glob.glob(f"{SF}/*.parquet"), reason="test tables are not here")

# Model fits, hashed vectors, section chunks and approximate neighbours have no SQL twin; others must have one.
ROWS_ONLY = {
    "ml_prep", "ml_train_score", "ml_boosted", "ml_batch_score", "ml_lookup_score",
    "embed_hashing", "text_classify", "chunk_sections", "vector_ann_neighbours",
}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", KEYS)
def test_query(spark, con, key):
    problem = compare(spark, key, entry.queries()[key], entry.oracle_sql().get(key), con, SF)
    assert problem in (None, "oracle is empty"), problem


def test_only_listed_queries_lack_sql():
    assert set(KEYS) - set(entry.oracle_sql()) == ROWS_ONLY


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "silent_hours" in df.columns
