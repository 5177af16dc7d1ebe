"""Physical plans: what must and must not be in them."""

import re

import pytest

from scorewatch.operators import joins, metrics
from scorewatch.plans.catalog import QUERIES
from scorewatch.sources import testbed

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")
PYTHON_ALLOWED = {"batch_score_pandas"}
BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    return {name: plan(QUERIES[name](spark, sf_dir)) for name in BATCH}


def test_no_cross_or_nested_loop_joins(plans):
    assert [n for n, p in plans.items() if "NestedLoopJoin" in p or "CartesianProduct" in p] == []


def test_python_only_where_declared(plans):
    assert {n for n, p in plans.items() if any(node in p for node in PYTHON_NODES)} == PYTHON_ALLOWED


def test_review_queue_is_an_anti_join(plans):
    assert "LeftAnti" in plans["pending_feedback"] and "LeftOuter" not in plans["pending_feedback"]
    assert "TakeOrderedAndProject" in plans["pending_feedback"]


def test_one_scan_reports(plans):
    for name in ("confusion_grid", "threshold_sweep", "daily_performance", "reviewer_summary", "auc_exact"):
        assert plans[name].count("FileScan") == 1, name


def test_quality_report_reads_each_table_twice(plans):
    """Once for the rules of its columns, once for all rules of keys."""
    assert plans["quality_report"].count("FileScan") == 6


def test_exact_split_ranks_nothing(plans):
    assert "Window" not in plans["split_exact"] and "Exchange" not in plans["split_exact"]


def test_distinct_counts_do_not_expand(plans):
    assert [n for n in ("feedback_coverage", "feedback_coverage_7d") if "Expand" in plans[n]] == []


def test_listing_happens_on_executors(plans):
    """The files come out of a scan of the data source; no file index of the driver is in the plan."""
    assert "folder_listing" in plans["file_listing"] and "FileScan" not in plans["file_listing"]


def test_joins_run_nothing_while_planned(spark, sf_dir):
    """Hot keys and looked-up rows are part of the query."""
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    names = ("model_metrics", "performance_live", "log_attribution", "review_queue", "classify_outcome", "false_positive_feed", "feedback_coverage")
    for name in names:
        QUERIES[name](spark, sf_dir)
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_false_positive_feed_attributes_after_the_limit(plans):
    text = plans["false_positive_feed"]
    assert text.count("TakeOrderedAndProject") == 2 and "LeftSemi" in text


def test_scans_read_only_their_columns(plans):
    schema = lambda name: set(re.findall(r"ReadSchema: struct<([^>]*)>", plans[name]))
    assert schema("count_by_category") == {"c_custkey:bigint"}
    assert schema("outcome_counts") == {"event_id:bigint,event_type:string,value:double,props:string"}
    assert "PushedFilters: [In(event_type, [click,purchase,view])]" in plans["outcome_counts"]


def test_band_join_is_an_equi_join(spark, sf_dir):
    """Without broadcasts it is a sort-merge join on score and bucket."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(joins.log_attribution(testbed.predictions(spark, sf_dir), testbed.payload_log(spark, sf_dir)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") == 2 and "Nested" not in text


def test_tally_shuffle_serves_the_join(spark, sf_dir):
    """Feedback is shuffled once by prediction, combined; the join adds no exchange on that side."""
    p, f = testbed.predictions(spark, sf_dir), testbed.feedback(spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(metrics.confidence_histogram(p, f))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning(prediction_id") == 2  # one per table


def test_attribution_sorts_instead_of_pairing(plans):
    assert "Window" in plans["log_attribution_nearest"] and "Window" in plans["band_join_bucketed"]
