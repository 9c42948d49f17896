"""From priced offers to reports and campaign lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwise.functions import percent_label
from offerwise.operators.metrics import value_shares
from offerwise.operators.scenarios import GRID, expand_scenarios
from offerwise.operators.scoring import Scorer
from offerwise.operators.value import DOWNGRADE_RATIO, with_expected_value


def scored_scenarios(
    cohort: DataFrame,
    scorer: Scorer,
    grid: Sequence[float] = GRID,
    alpha: float = DOWNGRADE_RATIO,
) -> DataFrame:
    """Every customer at every discount, with probabilities and expected value."""
    return with_expected_value(scorer(expand_scenarios(cohort, grid)), alpha)


def discount_distribution(offers: DataFrame) -> DataFrame:
    """Share of customers per recommended discount."""
    shares = value_shares(offers, "simulated_discount")
    return shares.withColumn("discount", percent_label(F.col("simulated_discount")))


def target_list(offers: DataFrame) -> DataFrame:
    """The campaign table: whole amounts and a discount label per customer.

    Recent disruptions are listed where the cohort has them.
    """
    columns = [
        F.col("username").alias("user_id"),
        F.col("current_arpu").cast("bigint").alias("current_arpu"),
        F.col("arpu").cast("bigint").alias("offered_arpu"),
    ]
    if "rolling_3_disruptioncount" in offers.columns:
        columns.append(F.col("rolling_3_disruptioncount").alias("recent_disruptions"))
    columns += [
        F.col("catalog_price").cast("bigint").alias("base_price"),
        percent_label(F.col("simulated_discount")).alias("recommended_discount"),
        F.col("offered_price").cast("bigint").alias("final_offer_price"),
    ]
    return offers.select(*[c for c in ("purchaseid",) if c in offers.columns], *columns)


def preview(targets: DataFrame, rows: int = 15) -> DataFrame:
    """The first rows of a campaign table, by its first column."""
    return targets.orderBy(*[F.asc_nulls_first(c) for c in targets.columns]).limit(rows)


def ev_curve(
    cohort: DataFrame,
    scorer: Scorer,
    key: str = "purchaseid",
    grid: Sequence[float] = GRID,
    alpha: float = DOWNGRADE_RATIO,
    ordered: bool = False,
) -> DataFrame:
    """Expected value against discount for each customer, sorted for a plot only if asked."""
    curve = scored_scenarios(cohort, scorer, grid, alpha).select(
        key, "scenario_id", "simulated_discount", "offered_price", "expected_value"
    )
    return curve.orderBy(key, "scenario_id") if ordered else curve
