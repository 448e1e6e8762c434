"""Physical-plan checks: the plans we want at scale, not only right answers."""

import pytest

from conftest import SF01
from eventide.operators.enrich import enrich_users
from eventide.plans import batch as B
from eventide.sources.tables import users_dimension


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


BIG = ["enriched_anomalies_1min", "zscore_1min", "anomalies_1min", "anomaly_severity_1day", "enrich_left_join",
       "parse_events", "dead_letter_split", "natural_key_dedup", "merge_upsert", "agg_batch_audit",
       "alert_message", "constraint_violations", "log_tail"]


@pytest.mark.parametrize("key", BIG)
def test_no_python_udf_no_cross_join(spark, key):
    from eventide.plans.registry import QUERIES
    plan = physical(QUERIES[key](spark, SF01))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, (key, bad)


def test_no_unpartitioned_window_on_counts(spark):
    # batch statistics come from a scalar subquery, not Window over all rows
    plan = physical(B.zscore_1min(spark, SF01))
    assert "Window" not in plan
    assert "Subquery" in plan


def test_dimension_is_broadcast_by_measured_bytes_only(spark):
    """No hint in the plan; with static estimates off, only the size that
    adaptive execution measured decides."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = enrich_users(B.tumbling_count_5s(spark, SF01), users_dimension(spark, SF01))
        assert "ResolvedHint" not in optimized(df) and "SortMergeJoin" in physical(df)
        df.collect()
        assert "BroadcastHashJoin [user_id" in physical(df).split("Initial Plan")[0]
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "1k")
        df = enrich_users(B.tumbling_count_5s(spark, SF01), users_dimension(spark, SF01))
        df.collect()
        assert "BroadcastHashJoin [user_id" not in physical(df).split("Initial Plan")[0]
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_scan_reads_only_needed_columns(spark):
    plan = physical(B.sliding_count_1min(spark, SF01))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan or \
           "ReadSchema: struct<user_id:bigint,ts:timestamp_ntz>" in plan or "struct<ts:timestamp_ntz,user_id:bigint>" in plan


def test_aggregate_shuffles_once_on_window_and_user(spark):
    plan = physical(B.tumbling_count_5s(spark, SF01))
    hashed = [l for l in plan.splitlines() if "Exchange hashpartitioning" in l]
    assert len(hashed) == 1 and "window" in hashed[0]
    assert "partial_count" in plan  # map-side combine before the shuffle


def test_json_parsed_once_per_row(spark):
    for q in (B.parse_events, B.dead_letter_split):
        plan = physical(q(spark, SF01))
        assert plan.count("from_json(") == 1, q.__name__


def test_dedup_reads_once_and_aggregates_by_hash(spark):
    df = B.natural_key_dedup_q(spark, SF01)
    df.collect()
    plan = physical(df).split("Initial Plan")[0]
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "row_number" not in plan
    assert plan.count("FileScan") == 1, plan


def test_sliding_counts_expand_panes_not_events(spark):
    plan = physical(B.sliding_count_1min(spark, SF01))
    expand, shuffle = plan.index("Expand"), [i for i in range(len(plan)) if plan.startswith("Exchange hashpartitioning", i)]
    assert len(shuffle) == 2 and shuffle[0] < expand < shuffle[1]  # printed from the result down to the scan


def test_lengths_that_are_no_multiple_of_the_slide(spark):
    from eventide.operators.windows import flatten_window, window_counts

    df = spark.sql("SELECT 1 AS user_id, timestamp'2024-01-01 00:00:03' AS event_time")
    for length in ("7 seconds", "10 seconds"):
        found = flatten_window(window_counts(df, length, "5 seconds")).collect()
        assert sorted(r["window_start"].second for r in found) == ([0, 55] if length == "10 seconds" else [0])
        assert [r["event_count"] for r in found] == [1] * len(found)


def test_tail_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in physical(B.log_tail(spark, SF01))


def test_filters_reach_the_scan(spark):
    plan = physical(B.log_tail(spark, SF01))
    pushed = [l.split("PushedFilters: ")[1] for l in plan.splitlines() if "PushedFilters: " in l]
    assert any("GreaterThanOrEqual(ts," in p for p in pushed), pushed


def test_alerts_are_parsed_once(spark):
    for query in (B.alert_message, B.alert_schema_check):
        plan = query(spark, SF01)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1, plan


def test_statistics_reuse_the_count_shuffle(spark):
    df = B.zscore_1min(spark, SF01)
    df.collect()
    assert "ReusedExchange" in physical(df)
