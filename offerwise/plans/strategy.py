"""Comparisons of discount policies over a whole portfolio."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerwise.functions import even_grid, nan_to_null, number
from offerwise.operators.scenarios import (
    GRID,
    WIDE_GRID,
    expand_scenarios,
    override,
    prepare_cohort,
)
from offerwise.operators.scoring import Scorer, in_between, score_at_discounts
from offerwise.operators.value import (
    DOWNGRADE_RATIO,
    best_offer,
    expected_value,
)
from offerwise.schemas import LABEL, PROBABILITIES, feature_columns

# The flat campaign, and the value below which no offer is made.
RISK_THRESHOLD = 0.50
FLAT_DISCOUNT = 0.15
NO_OFFER = -1.0
ALPHAS = tuple(even_grid(0.40, 0.90, 6))


def threshold_discount(
    risk: Column, threshold: float = RISK_THRESHOLD, discount: float = FLAT_DISCOUNT
) -> Column:
    """The flat discount for every customer whose churn risk exceeds the threshold."""
    return F.when(risk > threshold, F.lit(discount)).otherwise(F.lit(0.0))


def is_churn(label: str = LABEL) -> Column:
    """The three-state outcome as a binary label: 1 for churn."""
    return (F.col(label) == 2).cast("int")


def strategy_comparison(
    portfolio: DataFrame,
    scorer: Scorer,
    risk: str | None = None,
    threshold: float = RISK_THRESHOLD,
    flat: float = FLAT_DISCOUNT,
    grid: Sequence[float] = GRID,
    alpha: float = DOWNGRADE_RATIO,
    probs: str = "static",
) -> DataFrame:
    """One row: how many discounts a flat campaign and value maximisation hand out.

    `risk` names a column with a binary model's churn risk; without it the
    scorer's own churn probability on today's features decides. With static
    probabilities a higher price is always worth more, so value maximisation
    hands out no discount by construction; 'rescored' lets demand respond.
    """
    if risk is None:
        scored = scorer(portfolio)
        portfolio = scored.withColumn("_risk", F.col("p_churn")).drop(*PROBABILITIES)
    else:
        portfolio = portfolio.withColumn("_risk", F.col(risk))
    portfolio = portfolio.withColumn("_flat", threshold_discount(F.col("_risk"), threshold, flat))
    offers = best_offer(portfolio, scorer, grid, alpha, probs, above=NO_OFFER)
    chosen = F.col("simulated_discount")
    counted = offers.agg(
        F.count(F.lit(1)).alias("users"),
        F.count_if(F.col("_flat") > 0).alias("threshold_discounts"),
        F.count_if(chosen > 0).alias("value_discounts"),
        (F.coalesce(F.avg(F.when(chosen > 0, chosen)), F.lit(0.0)) * 100).alias(
            "value_mean_discount"
        ),
    )

    def rate(count: str) -> Column:
        return F.when(F.col("users") > 0, F.col(count) * 100.0 / F.col("users"))

    return counted.select(
        "users",
        "threshold_discounts",
        rate("threshold_discounts").alias("threshold_rate"),
        "value_discounts",
        rate("value_discounts").alias("value_rate"),
        "value_mean_discount",
        (F.col("threshold_discounts") - F.col("value_discounts")).alias("discounts_saved"),
    )


def is_on_grid(discount: float, flat: float) -> bool:
    return abs(discount - flat) <= 1e-8 + 1e-5 * abs(flat)


def alpha_sensitivity(
    portfolio: DataFrame,
    scorer: Scorer,
    alphas: Sequence[float] = ALPHAS,
    grid: Sequence[float] = GRID,
    flat: float = FLAT_DISCOUNT,
    probs: str = "static",
) -> DataFrame:
    """Portfolio value per alpha: best discount each, the flat discount, no discount.

    The probabilities do not depend on alpha, so each scenario is scored once
    and only its value depends on alpha. All alphas come from one pass and one
    row of sums. A flat discount that is not on the grid is priced besides it.
    """
    offered = range(len(grid))
    if not any(is_on_grid(d, flat) for d in grid):
        grid = (*grid, flat)
    flat_at = [i for i, d in enumerate(grid) if is_on_grid(d, flat)]
    none_at = [i for i, d in enumerate(grid) if d == 0.0]
    prepared = prepare_cohort(portfolio.drop(*PROBABILITIES))
    scored = score_at_discounts(prepared, scorer, grid, probs)
    parts, names = [], []
    for i, (discount, (p_accept, p_downgrade, _)) in enumerate(zip(grid, scored.p, strict=True)):
        offer = f"(catalog_price * (1 - {number(discount)}))"
        parts += [f"{p_accept} * {offer}", f"{p_downgrade} * {offer}"]
        names += [f"_accept_{i}", f"_downgrade_{i}"]
    valued = in_between(scored.df, names, parts)

    def total(scenarios: Sequence[int], alpha: float) -> str:
        values = [
            f"nullif(_accept_{i} + _downgrade_{i} * {number(alpha)}, double('NaN'))"
            for i in scenarios
        ]
        if not values:
            return "0D"
        best = f"greatest({', '.join(values)})" if len(values) > 1 else values[0]
        return f"coalesce(sum({best}), 0D)"

    rows = ", ".join(
        f"struct({number(a)}, {total(offered, a)}, {total(flat_at, a)},"
        f" {total(none_at, a)})"
        for a in alphas
    )
    names = "alpha, dynamic_value, flat_value, undiscounted_value"
    totals = valued.agg(F.expr(f"array({rows})").alias("rows"))
    return totals.selectExpr(f"inline(rows) AS ({names})").orderBy("alpha")


# The high-risk customer whose elasticity is checked.
RISKY_PROFILE = {
    "catalog_price": 100000.0,
    "hidden_discount_percentage": 0.0,
    "hidden_discount_amount": 0.0,
    "arpu_trend": -50.0,
}


def mean_profile(df: DataFrame, worst: Sequence[str] = ()) -> DataFrame:
    """One row: the mean of every feature, but the maximum of those named in `worst`."""
    features = feature_columns(df)

    def clean(c: str) -> Column:
        return nan_to_null(F.col(c).cast("double"))

    return df.agg(
        *[(F.max if c in worst else F.avg)(clean(c)).alias(c) for c in features]
    )


def elasticity_curve(
    training: DataFrame,
    scorer: Scorer,
    overrides: Mapping[str, float] = RISKY_PROFILE,
    worst: Sequence[str] = ("disruptioncount",),
    grid: Sequence[float] = WIDE_GRID,
    alpha: float = DOWNGRADE_RATIO,
    quoted: bool = False,
) -> DataFrame:
    """One customer's probabilities and value at each discount, the best one flagged.

    The customer is the mean of the training rows with some features replaced.
    Offers change its features as they do for any cohort. `quoted=True` feeds
    the discount in percent and the offered price itself as ARPU, and leaves
    the trend alone, as a quotation would put it.
    """
    profile = override(mean_profile(training, worst), overrides)
    if quoted:
        profile = override(profile, {"arpu": F.col("catalog_price")})
    offers = expand_scenarios(profile, grid)
    if quoted:
        offers = offers.withColumns(
            {
                "hidden_discount_percentage": F.col("simulated_discount") * 100,
                "arpu": F.col("offered_price"),
                "arpu_trend": F.col("current_arpu") - F.col("prev_arpu_actual"),
            }
        )
    value = nan_to_null(expected_value(alpha))
    eligible = F.when(value > NO_OFFER, value)
    # One customer: the window holds one row per discount.
    best_first = Window.partitionBy().orderBy(F.desc_nulls_last(eligible), "scenario_id")
    return (
        scorer(offers)
        .select(
            "scenario_id",
            "simulated_discount",
            "offered_price",
            *PROBABILITIES,
            value.alias("expected_value"),
            (F.row_number().over(best_first) == 1).alias("is_best"),
        )
        .orderBy("scenario_id")
    )
