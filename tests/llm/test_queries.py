"""Registered corpus queries: contract columns, and DuckDB twins where there are any."""

import re

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"
COLUMNS = {
    1: ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    2: ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    3: ["doc_id", "text", "source", "copy_no"],
    4: ["doc_id", "held_out", "score", "predicted"],
    5: ["doc_id", "held_out", "score", "predicted"],
    6: ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    7: ["doc_id", "n_found", "text"],
    8: ["doc_id", "class_id", "n_links"],
    9: ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    10: ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    11: ["page_id", "host", "path", "rule", "verdict"],
    12: ["doc_id", "n_features", "weight", "score", "rank"],
    13: ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
}
NAMES = {int(re.match(r"op(\d+)_", k)[1]): k for k in entry.queries() if re.match(r"op\d+_", k)}


def test_all_are_registered():
    assert sorted(NAMES) == sorted(COLUMNS) and "pipeline" in entry.queries()
    assert {k for k in entry.oracle_sql() if k in NAMES.values()} == {NAMES[n] for n in (3, 6, 9, 11, 12, 13)}


@pytest.mark.parametrize("n", sorted(COLUMNS))
def test_query(spark, n):
    name = NAMES[n]
    assert compare(spark, name, entry.queries()[name], entry.oracle_sql().get(name), duck(SF), SF) is None
    made = entry.queries()[name](spark, SF)
    assert set(COLUMNS[n]) <= set(made.columns)
    if n in range(1, 11) and n != 3:
        assert made.count() == 200


def test_workers_keep_one_object():
    from millrace.llm import common

    made = []
    for key in [("a", 1), ("a", 1), ("b", 1), ("b", 1), ("a", 1)]:
        assert common.worker_state(key, lambda: made.append(key) or key) == key
    assert made == [("a", 1), ("b", 1), ("a", 1)]
