"""Expected value of an offer and the offer that maximises it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerwise.functions import nan_to_null, number
from offerwise.operators.scenarios import GRID, at_discount, prepare_cohort
from offerwise.operators.scoring import Scenarios, Scorer, score_at_discounts
from offerwise.schemas import PROBABILITIES

# Fixed value: share of the offered price a downgrading customer still pays.
DOWNGRADE_RATIO = 0.70


def expected_value(alpha: float = DOWNGRADE_RATIO) -> Column:
    """p_accept * offer + p_downgrade * offer * alpha; a churned customer pays nothing."""
    offer = F.col("offered_price")
    return F.col("p_accept") * offer + F.col("p_downgrade") * (offer * alpha)


def with_expected_value(scored: DataFrame, alpha: float = DOWNGRADE_RATIO) -> DataFrame:
    return scored.withColumn("expected_value", expected_value(alpha))


def optimal_discount(valued: DataFrame, *key: str) -> DataFrame:
    """The best row per key of a scenario frame: highest value, lowest discount among equals.

    NaN and NULL values never win unless a key has nothing else; then its
    smallest discount is returned. The maximum is combined map-side. For a
    cohort that is not expanded yet, `best_offer` needs no shuffle at all.
    """
    value = nan_to_null(F.col("expected_value"))
    rest = [c for c in valued.columns if c not in key]
    ranked = F.struct(
        value.isNotNull().alias("valid"),
        value.alias("value"),
        (-F.col("scenario_id")).alias("rank"),
        F.struct(*rest).alias("row"),
    )
    best = valued.groupBy(*key).agg(F.max(ranked).alias("best"))
    return best.select(*key, *[F.col(f"best.row.{c}").alias(c) for c in rest])


def best_offer(
    cohort: DataFrame,
    scorer: Scorer,
    grid: Sequence[float] = GRID,
    alpha: float = DOWNGRADE_RATIO,
    probs: str = "rescored",
    above: float | None = None,
) -> DataFrame:
    """Add each row's best discount, its offer, probabilities and expected value.

    Scores the scenarios of a row side by side and takes the greatest, so the
    whole prescription is a narrow projection: rows are neither multiplied nor
    shuffled, and equal keys cannot collide. `probs='static'` scores once, on
    the features as they are, and only varies the price. Only values greater
    than `above` are eligible; a row without one gets discount 0.
    """
    prepared = prepare_cohort(cohort.drop(*PROBABILITIES))
    scored = score_at_discounts(prepared, scorer, grid, probs)
    values = [f"nullif({v}, double('NaN'))" for v in option_values(scored, grid, alpha)]
    df = scored.df.selectExpr("*", *[f"{v} AS _value_{i}" for i, v in enumerate(values)])
    if above is not None:
        limit = number(above)
        df = df.withColumns(
            {f"_value_{i}": F.expr(f"CASE WHEN _value_{i} > {limit} THEN _value_{i} END")
             for i in range(len(grid))}
        )
    # greatest() needs two arguments; it skips NULLs, so one may be repeated.
    names = [f"_value_{i}" for i in (*range(len(grid)), 0)]
    df = df.withColumn("_best", F.expr(f"greatest({', '.join(names)})"))
    # The first scenario that reaches the best value has the smallest such discount.
    reached = " ".join(f"WHEN _value_{i} = _best THEN {i}" for i in range(len(grid)))
    df = df.withColumn("_winner", F.expr(f"CASE {reached} ELSE 0 END"))
    discounts = " ".join(f"WHEN {i} THEN {number(d)}" for i, d in enumerate(grid))
    df = df.withColumn("_chosen", F.expr(f"CASE _winner {discounts} END"))
    p = [f"CASE WHEN _best IS NOT NULL THEN {p} END" for p in scored.p_chosen("_winner", "_chosen")]
    offer = f"inline(array(struct(_winner, _chosen, {', '.join(p)}, _best)))"
    columns = ["scenario_id", "_discount", *PROBABILITIES, "expected_value"]
    # Filters on the offer stay above this generator. Pushed further down they
    # would repeat the expressions of all scenarios many times over.
    kept = [f"`{c}`" for c in prepared.columns]
    df = df.selectExpr(*kept, f"{offer} AS ({', '.join(columns)})")
    return at_discount(df, "_discount").drop("_discount")


def option_values(scored: Scenarios, grid: Sequence[float], alpha: float) -> list[str]:
    """SQL of the expected value of every scenario."""
    values = []
    for discount, (p_accept, p_downgrade, _) in zip(grid, scored.p, strict=True):
        offer = f"cast(catalog_price as double) * (1 - {number(discount)})"
        values.append(f"({p_accept} * {offer} + {p_downgrade} * ({offer} * {number(alpha)}))")
    return values
