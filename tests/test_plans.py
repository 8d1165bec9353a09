"""Shapes that every registered query's plan must have, with and without broadcasts."""

from __future__ import annotations

import pytest
from helpers import final_plan, static_plan

from acctmart.checks import registry

FOLDER = "/root/testdata/sf0.001"
QUERIES = registry.queries()
# One task sums one row per shuffle partition, or gathers at most 15 level numbers.
FEW_ROWS_IN_ONE_TASK = {"dense_ids", "customer_queue", "phone_rank", "postal_lookup"}


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, settings, name, threshold):
    settings({"spark.sql.autoBroadcastJoinThreshold": threshold})
    plan = static_plan(QUERIES[name](spark, FOLDER))
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas"):
        assert unwanted not in plan
    if name not in FEW_ROWS_IN_ONE_TASK:
        assert "SinglePartition" not in plan


@pytest.mark.parametrize(
    "name,column",
    [
        ("month_invoices", "o_orderdate"),
        ("month_payments", "l_shipdate"),
        ("account_mart", "o_orderdate"),
        ("account_mart", "l_shipdate"),
    ],
)
def test_month_filter_is_pushed_down(spark, name, column):
    plan = static_plan(QUERIES[name](spark, FOLDER))
    assert f"GreaterThanOrEqual({column}," in plan and f"LessThan({column}," in plan


def test_payments_are_scanned_and_shuffled_once(spark, settings):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    for name in ("payment_totals", "account_mart"):
        plan = final_plan(QUERIES[name](spark, FOLDER))
        scans = [s for s in plan.splitlines() if "FileScan" in s and "l_shipdate" in s]
        assert len(scans) == 1, name
        assert "ReusedExchange" in plan
