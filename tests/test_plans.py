"""Plan-shape guards on the batch queries (no cross products, pruned scans,
aggregation before joins)."""
import re

import pytest

import __spark_entry__ as E
from conftest import SMALL

BATCH = ["session_summary", "visit_minutes", "envelope_decode", "topic_week_counts",
         "epoch_to_timestamp", "envelope_encode", "visit_upsert", "start_stop_pairs",
         "readings_in_sessions", "readings_bucketed", "age_bins", "validity_flag"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_products(spark, name):
    plan = _plan(E.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_summary_aggregates_before_joining(spark):
    df = E.queries()["session_summary"](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the partial aggregate of the readings sits below every join
    first_join = min(plan.find("Join"), len(plan))
    assert plan.rfind("partial_min") > first_join
    # the readings scan reads only the two columns it needs
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_no_plan_probes_a_side_in_one_task(spark):
    """No join side is counted or limited on a single partition before the join."""
    for name in ("session_summary", "visit_minutes", "age_bins"):
        assert "SinglePartition" not in _plan(E.queries()[name](spark, SMALL))


def test_reading_rule_reaches_the_scan(spark):
    """The rule is a plain comparison right above the scan, which parquet row groups can
    be skipped by; no coalesce stands around it."""
    plan = E.queries()["readings_in_sessions"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    rule = [x for x in plan.splitlines() if "Filter" in x and "click" in x][0]
    assert re.search(r"value#\d+ >= 1\.0", rule) and re.search(r"value#\d+ <= 220\.0", rule)
    assert "coalesce(" not in rule


def test_colocated_tables_join_without_an_exchange(spark):
    df = E.queries()["colocated_visits"](spark, SMALL)
    plan = _plan(df)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert df.where("n = 0").where("newest is not null").count() == 0


def test_colocated_tables_keep_all_rows(spark):
    """NULL and hot keys, repeated rows and an empty side; rewriting replaces the rows."""
    from pulsehouse.operators.maintenance import write_colocated
    from pulsehouse.session import scratch_dir
    root = scratch_dir(spark, "test_colocated")
    rows = [(None, 1), (None, 1), (7, 2), (7, 2)] + [(7, i) for i in range(50)] + [(i, i) for i in range(20)]
    df = spark.createDataFrame(rows, "k long, v long")
    a = write_colocated(df, "test_colocated_a", ["k"], 4, f"{root}/a", ["v"])
    b = write_colocated(df.limit(0), "test_colocated_b", ["k"], 4, f"{root}/b")
    assert sorted(map(tuple, a.collect()), key=str) == sorted(rows, key=str)
    assert a.join(b, "k", "left").count() == len(rows) and a.join(b, "k").count() == 0
    again = write_colocated(df.where("k = 7"), "test_colocated_a", ["k"], 4, f"{root}/a")
    assert again.count() == 53
    # one file for each bucket that has rows
    assert len(again.inputFiles()) == 1
    spark.sql("DROP TABLE test_colocated_a")
    spark.sql("DROP TABLE test_colocated_b")
