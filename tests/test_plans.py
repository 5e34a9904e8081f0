"""What the plans must look like: pruned scans, no pairwise joins, limits below the shuffle."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def plan(spark, key):
    return entry.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["join_interval", "join_theta_bucketed", "join_asof", "pit_lookup", "join_overlap_priority", "visit_consolidation", "usage_cost",
                                 "metric_trailing", "metric_distinct_trailing", "drift_js_tv_linf", "drift_baseline", "vector_topk", "join_cross"])
def test_no_pairwise_join(spark, key):
    text = plan(spark, key)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("key", ["win_latest", "win_topn_group", "sample_per_group", "audit_reports", "vector_topk"])
def test_group_limit_below_shuffle(spark, key):
    text = plan(spark, key)
    assert "WindowGroupLimit" in text and "Partial" in text


@pytest.mark.parametrize("key", ["pit_lookup", "win_lag_lead", "win_running", "sessionize_batch"])
def test_one_shuffle(spark, key):
    # sessions are numbered and then totalled on the partitioning of the user
    assert plan(spark, key).count("Exchange hashpartitioning") == 1


def test_scan_reads_only_what_it_needs(spark):
    text = plan(spark, "predicates")
    assert "PushedFilters: [IsNotNull" in text and "o_totalprice" in text
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "o_orderkey" in schema and plan(spark, "agg_stddev").count("ts:") == 0


def test_asof_join_has_no_join(spark):
    assert "Join" not in plan(spark, "pit_lookup")


def test_surrogate_key_window_is_chunked(spark):
    text = plan(spark, "surrogate_key")
    assert "__chunk" in text
