"""Plan-shape guards over every registered query: patterns that do not
survive large data must not appear in any physical plan."""
import os
import re

import pytest

import __spark_entry__ as E
from wharf.plans.registry import load_all

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

FORBIDDEN = {
    "CartesianProduct": "cross join",
    "BroadcastNestedLoopJoin": "nested-loop join (non-equi or correlated form)",
    "BatchEvalPython": "row-at-a-time Python UDF",
    "ArrowEvalPython": "Python UDF on the row path",
    "FlatMapGroupsInPandas": "whole group through Python",
}
# a window whose spec starts with a sort order or a frame has no partition key: one task
UNPARTITIONED_WINDOW = re.compile(
    r"windowspecdefinition\((?:[^,()]+ (?:ASC|DESC) NULLS (?:FIRST|LAST)|specifiedwindowframe)")


def plan_of(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def assert_scalable(plan, what):
    for node, why in FORBIDDEN.items():
        assert node not in plan, f"{what}: {why} ({node}) in plan"
    assert not UNPARTITIONED_WINDOW.search(plan), f"{what}: unpartitioned window"


# queries that write state end in a plain read of what they wrote; their inner
# plans (merges, fact changes) are checked below instead
PURE = sorted(n for n, q in load_all().items() if not q.stateful)


@pytest.mark.parametrize("name", PURE)
def test_no_unscalable_operators(spark, name):
    assert_scalable(plan_of(spark, name), name)


def test_inner_plans_of_incremental_jobs(spark):
    from wharf.operators.incremental import insert_new, stamp_and_merge
    from wharf.plans import payments as pay
    from wharf.plans import standins as si
    from wharf.plans.loads import copy_sources
    ts1, ts2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
    acc1 = pay.stage(pay.clean_acceptance(si.acceptance_seed(spark, SF)), ts1, check_unique=False)
    cb1 = pay.stage(pay.clean_chargeback(si.chargeback_seed(spark, SF)), ts1, check_unique=False)
    fact1 = pay.build_fact(acc1, cb1, ts1)
    acc2 = stamp_and_merge(pay.clean_acceptance(si.acceptance_seed(spark, SF)), acc1, "transaction_id", ts2)
    changes = pay.fact_changes(acc2, cb1, ts2, fact1, backfill_days=3)
    (o1, _), (o2, _) = copy_sources(spark, SF)
    fresh, _ = insert_new(o1.withColumn("import_date", o1["created_at"]), o2, "o_orderkey", "2002-01-01",
                          order_cols=["created_at"])
    for what, df in [("staging merge", acc2), ("fact changes", changes),
                     ("fact merge", pay.merge_fact(changes, fact1)), ("insert_new", fresh)]:
        assert_scalable(df._jdf.queryExecution().executedPlan().toString(), what)


def test_top1_limits_before_shuffle(spark):
    plan = plan_of(spark, "top1_week")
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_period_totals_prunes_and_pushes(spark):
    plan = plan_of(spark, "period_totals")
    scan = [line for line in plan.split("\n") if "FileScan" in line and "l_shipdate" in line][0]
    assert "GreaterThanOrEqual(l_shipdate" in scan and "LessThan(l_shipdate" in scan
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in scan
