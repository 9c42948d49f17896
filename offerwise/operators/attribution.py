"""Which features moved a row's margins, and how far, from the mean customer's.

The margins of a softmax model are linear, so a feature's part is its coefficient times its
distance from the mean: the parts of a row add up to its margins minus the mean customer's.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwise.functions import number
from offerwise.operators.scenarios import align_features
from offerwise.operators.scoring import MISSING, SoftmaxScorer, model_input
from offerwise.schemas import PROBABILITIES

OUTCOME_MARGINS = tuple(p.removeprefix("p_") for p in PROBABILITIES)


def input_means(df: DataFrame, scorer: SoftmaxScorer) -> dict[str, float]:
    """The mean of every input of the model: one row, one pass. An empty table gives zeros."""
    df = align_features(df, [f.removesuffix(MISSING) for f in scorer.features])
    means = df.agg(*[F.avg(F.expr(model_input(f))).alias(f) for f in scorer.features]).first()
    return {f: means[f] or 0.0 for f in scorer.features}


def mean_margins(scorer: SoftmaxScorer, means: Mapping[str, float]) -> list[float]:
    """The margins of the mean customer, in outcome order."""
    return [
        b + sum(w * means[f] for f, w in zip(scorer.features, weights, strict=True))
        for b, weights in zip(scorer.intercepts, scorer.coefficients, strict=True)
    ]


def _parts(scorer: SoftmaxScorer, means: Mapping[str, float]) -> str:
    """SQL of the array of a row's features, each with its value and its part of each margin."""
    entries = []
    for feature in dict.fromkeys(f.removesuffix(MISSING) for f in scorer.features):
        parts = []
        for weights in scorer.coefficients:
            weight_of = dict(zip(scorer.features, weights, strict=True))
            terms = [
                f"{number(weight_of[f])} * ({model_input(f)} - {number(means[f])})"
                for f in (feature, feature + MISSING)
                if f in weight_of
            ]
            parts.append(" + ".join(terms))
        named = ", ".join(f"{p} AS {n}" for p, n in zip(parts, OUTCOME_MARGINS, strict=True))
        entries.append(f"struct('{feature}' AS feature, cast(`{feature}` AS double) AS value, {named})")
    return f"array({', '.join(entries)})"


def attributions(
    df: DataFrame, scorer: SoftmaxScorer, means: Mapping[str, float], key: str = "purchaseid"
) -> DataFrame:
    """A row per row of `df` and feature: its value and its part of each outcome's margin.

    `means` is the profile to compare with, see `input_means`. A feature and the flag that it
    is missing count as one. No row is moved.
    """
    df = align_features(df, [f.removesuffix(MISSING) for f in scorer.features])
    return df.selectExpr(f"`{key}`", f"inline({_parts(scorer, means)})")


def importance(parts: DataFrame) -> DataFrame:
    """Per feature the mean size of its parts, and its place by the one for churn."""
    means = parts.groupBy("feature").agg(*[F.avg(F.abs(m)).alias(m) for m in OUTCOME_MARGINS])
    return means.orderBy(F.desc(OUTCOME_MARGINS[-1]), "feature")


def reasons(
    df: DataFrame,
    scorer: SoftmaxScorer,
    means: Mapping[str, float],
    top: int = 3,
    key: str = "purchaseid",
) -> DataFrame:
    """The `top` features of each row that raised its churn margin the most above that of
    accepting, strongest first; ties by name. Features that did not raise it are left out."""
    df = align_features(df, [f.removesuffix(MISSING) for f in scorer.features])
    raised = f"filter({_parts(scorer, means)}, p -> p.churn > p.accept)"
    pulls = f"array_sort(transform({raised}, p -> struct(p.accept - p.churn AS pull, p.feature AS feature)))"
    return df.selectExpr(f"`{key}`", f"transform(slice({pulls}, 1, {int(top)}), p -> p.feature) AS reasons")
