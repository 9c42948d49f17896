"""Discount scenarios: what a customer's features become at a discount."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerwise.functions import discount_grid, is_close, number
from offerwise.schemas import require_columns

# Discounts offered, columns a cohort must have, columns an offer changes.
GRID = tuple(discount_grid(30, 5))  # 0 % to 30 %
WIDE_GRID = tuple(discount_grid(40, 5))  # 0 % to 40 %

REQUIRED = ("catalog_price", "arpu", "arpu_trend", "duration")
REPRICED = ("hidden_discount_percentage", "hidden_discount_amount", "arpu", "arpu_trend")


def prepare_cohort(cohort: DataFrame) -> DataFrame:
    """Check the cohort and keep today's revenue beside the columns offers overwrite."""
    require_columns(cohort, REQUIRED, "cohort")
    return cohort.withColumns(
        {
            "current_arpu": F.col("arpu"),
            "prev_arpu_actual": F.col("arpu") - F.col("arpu_trend"),
        }
    )


def at_discount(cohort: DataFrame, discount: float | str) -> DataFrame:
    """Recompute every price-dependent feature of a prepared cohort.

    `discount` is a number or the name of a column.
    """
    share = f"`{discount}`" if isinstance(discount, str) else number(discount)
    catalog = "cast(catalog_price as double)"
    offered = f"{catalog} * (1 - {share})"
    arpu = f"CASE WHEN duration > 0 THEN {offered} / duration ELSE 0D END"
    repriced = {
        "simulated_discount": share,
        "offered_price": offered,
        "hidden_discount_percentage": share,
        "hidden_discount_amount": f"{catalog} - {offered}",
        "arpu": arpu,
        "arpu_trend": f"{arpu} - prev_arpu_actual",
    }
    return cohort.withColumns({name: F.expr(sql) for name, sql in repriced.items()})


def expand_scenarios(cohort: DataFrame, grid: Sequence[float] = GRID) -> DataFrame:
    """One row per customer and discount, by exploding literals: no shuffle."""
    steps = ", ".join(f"struct({i}, {number(d)})" for i, d in enumerate(grid))
    exploded = prepare_cohort(cohort).selectExpr(
        "*", f"inline(array({steps})) as (scenario_id, _discount)"
    )
    return at_discount(exploded, "_discount").drop("_discount")


def scenarios_at(expanded: DataFrame, discount: float) -> DataFrame:
    """The rows of one discount, compared with a tolerance."""
    return expanded.where(is_close(F.col("simulated_discount"), discount))


def override(df: DataFrame, values: Mapping[str, float | Column]) -> DataFrame:
    """Replace the named columns where they exist; others are ignored."""
    present = {k: v for k, v in values.items() if k in df.columns}
    return df.withColumns(
        {k: v if isinstance(v, Column) else F.lit(float(v)) for k, v in present.items()}
    )


def align_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add features the input lacks as 0.0, so that a model can be applied to it."""
    absent = [f for f in features if f not in df.columns]
    return df.withColumns({f: F.lit(0.0) for f in absent}) if absent else df
