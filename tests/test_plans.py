"""The shape of the physical plans."""

import pytest

from offerwise.operators.value import best_offer
from offerwise.plans.mart import build_mart
from offerwise.registry import inputs, queries

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_mart_has_one_window_and_two_exchanges(spark):
    log = inputs.purchases(spark, SF_DIR)
    plan = plan_of(build_mart(log, inputs.AS_OF))
    assert plan.count("Window [") == 1
    assert plan.count("Exchange hashpartitioning") == 2  # catalog cells; customers
    assert "BroadcastHashJoin" in plan


def test_prescription_is_narrow(spark):
    plan = plan_of(best_offer(inputs.cohort(spark, SF_DIR), inputs.SCORER))
    assert "Exchange" not in plan
    assert "Sort" not in plan


def test_label_filter_reaches_the_scan(spark):
    plan = plan_of(inputs.cohort(spark, SF_DIR).select("arpu"))
    assert "PushedFilters: [IsNotNull(customer_action)]" in plan
    assert "ReadSchema: struct<customer_action:int,arpu:double>" in plan


@pytest.mark.parametrize("name", ["q_mart", "q_target_list", "q_alpha_sensitivity_rescored",
                                  "q_class_report", "q_strategy_comparison"])
def test_no_python_in_plans(spark, name):
    plan = plan_of(queries.QUERIES[name](spark, SF_DIR))
    assert "Python" not in plan
    assert "Pandas" not in plan
