import math

import pytest
from pyspark.sql import functions as F

from offerwise.operators.scenarios import expand_scenarios
from offerwise.operators.scoring import ModelScorer, SoftmaxScorer
from offerwise.operators.value import best_offer, optimal_discount, with_expected_value
from offerwise.plans import prescription, strategy

COHORT = "username string, catalog_price double, arpu double, arpu_trend double, duration int"
SCORER = SoftmaxScorer(
    ("arpu", "arpu_trend", "hidden_discount_percentage", "gap_days", "gap_days_missing"),
    ((0.0, 0.0, 6.0, 0.01, 0.2), (0.1, 0.0, 0.0, 0.0, 0.0), (0.5, 0.1, -3.0, 0.0, 0.1)),
    (0.0, -0.3, 0.0),
)


def fixed_probabilities(p0, p1, p2):
    """A scorer that ignores the row; not linear, so it takes the general way."""

    def score(df):
        return df.withColumns(
            {"p_accept": F.lit(p0), "p_downgrade": F.lit(p1), "p_churn": F.lit(p2)}
        )

    return score


@pytest.fixture
def cohort(spark):
    rows = [
        ("a", 100.0, 3.0, 0.5, 30), ("b", 500.0, 20.0, -2.0, 30), ("c", 90.0, 1.0, 0.0, 0),
        ("d", 0.0, 0.0, 0.0, 30), ("e", None, 1.0, 0.0, 30), ("f", float("nan"), 1.0, 0.0, 30),
        ("g", -200.0, 1.0, 0.0, 30), ("h", 250.0, None, 1.0, 90), ("a", 300.0, 9.0, 0.0, 30),
    ]
    return spark.createDataFrame(rows, COHORT).withColumn("row", F.monotonically_increasing_id())


def test_side_by_side_equals_expanded(cohort):
    wide = best_offer(cohort, SCORER)
    valued = with_expected_value(SCORER(expand_scenarios(cohort)))
    long = optimal_discount(valued, "row")
    for a, b in zip(wide.orderBy("row").collect(), long.orderBy("row").collect(), strict=True):
        assert a.scenario_id == b.scenario_id, a
        assert a.simulated_discount == b.simulated_discount
        value = b.expected_value
        if value is None or math.isnan(value):
            assert a.expected_value is None
        else:
            assert a.expected_value == pytest.approx(value, rel=1e-9)
            assert a.p_churn == pytest.approx(b.p_churn, rel=1e-9)
            assert a.arpu == pytest.approx(b.arpu)


def test_linear_and_general_scoring_agree(cohort):
    general = best_offer(cohort, lambda df: SCORER(df))
    linear = best_offer(cohort, SCORER)
    for a, b in zip(linear.orderBy("row").collect(), general.orderBy("row").collect(), strict=True):
        assert a.scenario_id == b.scenario_id
        if b.expected_value is None:
            assert a.expected_value is None
        else:
            assert a.expected_value == pytest.approx(b.expected_value, rel=1e-9)


def test_ties_and_unknown_values_give_the_lowest_discount(cohort):
    offers = {r.username: r for r in best_offer(cohort, SCORER).collect()}
    for user in ("d", "e", "f"):  # all values 0, NULL, NaN
        assert offers[user].scenario_id == 0, user
    assert offers["e"].expected_value is None
    assert offers["f"].expected_value is None


def test_every_row_gets_one_offer_even_with_equal_names(cohort):
    assert best_offer(cohort, SCORER).count() == cohort.count()


def test_best_is_never_worse_than_no_discount(cohort):
    offers = best_offer(cohort, SCORER).where("catalog_price > 0")
    plain = with_expected_value(SCORER(expand_scenarios(cohort, [0.0])))
    joined = offers.join(plain.select("row", F.col("expected_value").alias("plain")), "row")
    assert joined.where("expected_value < plain - 1e-9").count() == 0


def test_static_probabilities_never_pay_for_a_discount(cohort):
    offers = best_offer(cohort.where("catalog_price >= 0"), SCORER, probs="static")
    assert {r.simulated_discount for r in offers.collect()} == {0.0}


def test_threshold_on_value_falls_back_to_no_discount(cohort):
    offers = best_offer(
        cohort.where("catalog_price < 0"), fixed_probabilities(0.5, 0.2, 0.3), above=-1.0
    )
    row = offers.first()
    assert (row.scenario_id, row.expected_value) == (0, None)


def test_filters_on_offers_do_not_inflate_the_plan(cohort):
    offers = best_offer(cohort, SCORER).where("simulated_discount > 0 and arpu > 1")
    plan = offers._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 40_000
    offers.count()


def test_cohort_must_have_price_columns(cohort):
    with pytest.raises(ValueError, match="arpu_trend"):
        best_offer(cohort.drop("arpu_trend"), SCORER)


def test_distribution_and_labels(cohort):
    rows = prescription.discount_distribution(best_offer(cohort, SCORER)).collect()
    assert sum(r.share_percent for r in rows) == pytest.approx(100)
    assert [r.discount for r in rows] == [f"{round(r.simulated_discount * 100)}%" for r in rows]


def test_target_list_truncates_and_adapts(cohort):
    offers = best_offer(cohort.where("username = 'b'"), SCORER)
    row = prescription.target_list(offers).first()
    assert "recent_disruptions" not in row
    assert (row.base_price, row.current_arpu) == (500, 20)
    assert row.final_offer_price == int(500 * (1 - offers.first().simulated_discount))


def test_strategy_counts(cohort):
    portfolio = cohort.where("catalog_price > 0 and not isnan(catalog_price)").withColumn(
        "risk", F.when(F.col("username") == "a", 0.5).otherwise(0.6)
    )
    row = strategy.strategy_comparison(portfolio, SCORER, risk="risk").first()
    assert row.users == 5
    assert row.threshold_discounts == 3  # exactly 0.5 is not above the threshold
    assert (row.value_discounts, row.value_mean_discount) == (0, 0.0)
    assert row.discounts_saved == 3


def test_alpha_sensitivity_orders_strategies(cohort):
    portfolio = cohort.where("catalog_price > 0")
    for r in strategy.alpha_sensitivity(portfolio, SCORER, probs="rescored").collect():
        assert r.dynamic_value >= max(r.flat_value, r.undiscounted_value) - 1e-9
    static = strategy.alpha_sensitivity(portfolio, SCORER).collect()
    assert [r.alpha for r in static] == [0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
    for r in static:
        assert r.dynamic_value == pytest.approx(r.undiscounted_value)
        assert r.flat_value == pytest.approx(0.85 * r.undiscounted_value)


def test_ev_curve_is_ordered(cohort):
    curve = prescription.ev_curve(cohort.where("row = 0 or username = 'b'"), SCORER, key="row")
    rows = curve.collect()
    assert len(rows) == 14
    assert [r.scenario_id for r in rows] == list(range(7)) * 2


def test_unknown_mode_is_refused(cohort):
    with pytest.raises(ValueError, match="static"):
        best_offer(cohort, SCORER, probs="frozen")
