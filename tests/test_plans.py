"""Physical plans: no Python in batch queries, filters and columns pushed to
the parquet scan, partial aggregation before the shuffle."""

import pytest

from livetable.plans.queries import QUERIES
from livetable.sources.files import read_table
from livetable.operators.aggregate import filtered_stats

from conftest import SF0001

BATCH_KEYS = ["wordcount_dsl", "nonblank_filter", "json_extract_fields",
              "iot_stats_sql", "iot_stats_dsl", "event_line_parse", "json_struct_parse",
              "top10_questions", "top10_grades", "top10_questions_with_subject",
              "lowest_score_students", "lowest_questions_per_student",
              "window_tumbling_daily", "id_to_number", "rating_bucket", "ratings_extract",
              "rmse_aggregate", "rmse_predictions", "hash_split_counts", "recs_to_string", "answers_join_recs",
              "registry_latest", "missing_id_xor"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH_KEYS)
def test_no_python_in_plan(spark, name):
    plan = _plan(QUERIES[name](spark, SF0001))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan, (name, node)


def test_filter_and_columns_reach_scan(spark):
    ev = read_table(spark, SF0001, "events")
    df = filtered_stats(ev, ev.value > 30, "event_type", "value")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,30.0)]" in plan
    assert "ReadSchema: struct<event_type:string,value:double>" in plan


def test_partial_aggregation_before_shuffle(spark):
    plan = _plan(QUERIES["wordcount_dsl"](spark, SF0001))
    assert plan.count("HashAggregate") >= 2 and "partial_count" in plan


def test_ranking_window_is_limited_before_shuffle(spark):
    # Let AQE be off for a stable plan string; the rule is in the logical plan.
    df = QUERIES["lowest_questions_per_student"](spark, SF0001)
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in opt


@pytest.mark.parametrize("name", BATCH_KEYS)
def test_no_cross_join_in_plan(spark, name):
    plan = _plan(QUERIES[name](spark, SF0001))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, (name, node)


def test_streaming_aggregation_is_partial_before_the_state_store(spark, tmp_path):
    """A hot window/word reaches the state store as one row per map task."""
    from livetable.plans.queries import _sliding
    from livetable.streaming.sinks import run_available_now
    q = run_available_now(_sliding(spark, SF0001), "noop", str(tmp_path / "ck"), "complete")
    plan = q._jsq.streamingQuery().lastExecution().executedPlan().toString()
    partial = plan.index("partial_count")
    exchange = plan.index("Exchange hashpartitioning")
    restore = plan.index("StateStoreRestore")
    assert restore < exchange < partial  # printed top-down: partial sits below the shuffle


@pytest.mark.parametrize("name", ["lowest_score_students", "registry_latest"])
def test_raw_rows_are_not_sorted_before_the_shuffle(spark, name):
    """The first aggregate over the rows is a hash aggregate of numbers or times."""
    plan = _plan(QUERIES[name](spark, SF0001)).split("== Initial Plan ==")[0]
    lines = plan.splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan" in line]
    for i, line in enumerate(lines):
        if "SortAggregate" in line and "partial_" in line:
            below = "\n".join(lines[i:])
            assert "Join" in below.split("FileScan")[0], plan  # only what a join has left
    assert scans and "HashAggregate" in plan
