"""Does a model respond to price the way it should?"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerwise.models import Learner, fit_outcome_model, scorer_of
from offerwise.operators.scoring import Scorer
from offerwise.operators.splits import sample_rows, split
from offerwise.plans.training import PRODUCTION, labelled
from offerwise.schemas import PROBABILITIES, feature_columns


def quantile_grid(df: DataFrame, feature: str, points: int = 20, accuracy: int = 10_000):
    """Distinct quantiles of a feature, evenly spaced in rank."""
    shares = [k / (points - 1) for k in range(points)]
    found = df.agg(F.percentile_approx(feature, shares, accuracy)).first()[0]
    return sorted(set(found or []))


def partial_dependence(
    df: DataFrame,
    scorers: Mapping[str, Scorer],
    feature: str,
    grid: Sequence[float],
    sample: int | None = None,
    key: str = "purchaseid",
) -> DataFrame:
    """Mean churn probability per model with `feature` set to each grid value in turn.

    Every row is scored at every grid value; the means are combined map-side.
    `sample` limits the rows like a plot would.
    """
    rows = df if sample is None else sample_rows(df, sample, key)
    points = F.array(
        *[
            F.struct(F.lit(i).alias("point"), F.lit(float(v)).alias("value"))
            for i, v in enumerate(grid)
        ]
    )
    at_points = rows.select("*", F.explode(points).alias("_grid")).withColumn(
        feature, F.col("_grid.value")
    )
    # All models score the same exploded rows, side by side.
    kept = [c for c in at_points.columns if c not in PROBABILITIES]
    scored, means = at_points.select(*kept), []
    for i, (name, scorer) in enumerate(scorers.items()):
        scored = scorer(scored).withColumnRenamed("p_churn", f"_churn_{i}").drop(*PROBABILITIES)
        means.append(
            F.struct(
                F.lit(name).alias("model"),
                F.first("_grid.value").alias("value"),
                F.avg(f"_churn_{i}").alias("mean_churn"),
                F.count(F.lit(1)).alias("rows"),
            )
        )
    by_point = scored.groupBy(F.col("_grid.point").alias("point")).agg(F.array(*means).alias("m"))
    return by_point.select("point", F.inline("m")).select("model", "point", "value", "mean_churn", "rows")


def falling_steps(curve: DataFrame) -> DataFrame:
    """Per model: how often, and at most by how much, churn falls as the feature grows."""
    along = Window.partitionBy("model").orderBy("point")
    step = F.col("mean_churn") - F.lag("mean_churn").over(along)
    # Differences of means this small are rounding.
    fell = F.col("step") < -1e-12
    return (
        curve.withColumn("step", step)
        .groupBy("model")
        .agg(
            F.count(F.lit(1)).alias("points"),
            F.count_if(fell).alias("falling_steps"),
            F.coalesce(F.max(F.when(fell, -F.col("step"))), F.lit(0.0)).alias("largest_fall"),
        )
    )


def constraint_audit(
    mart: DataFrame,
    feature: str = "arpu",
    points: int = 20,
    sample: int | None = None,
    key: str = "purchaseid",
) -> DataFrame:
    """Churn against price for a free and a price-constrained model, on unseen rows."""
    rows = labelled(mart)
    features = feature_columns(rows)
    if feature not in features:
        raise ValueError(f"{feature} is not a feature of the input")
    fitting, unseen = split(rows, key)
    scorers = {
        "baseline": scorer_of(fit_outcome_model(fitting, features, Learner())),
        "constrained": scorer_of(fit_outcome_model(fitting, features, PRODUCTION)),
    }
    grid = quantile_grid(unseen, feature, points)
    return partial_dependence(unseen, scorers, feature, grid, sample, key)
