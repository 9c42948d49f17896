"""Registered jobs on offers: envelopes over the downgrade ratio, monotone and calibrated
scores, and what moved a customer's score."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerwise.functions import even_grid
from offerwise.models import Learner, fit_outcome_model, scorer_of
from offerwise.operators import attribution
from offerwise.operators.calibrated import CalibratedScorer, Curve
from offerwise.operators.monotone import MonotoneScorer
from offerwise.operators.scenarios import GRID, prepare_cohort
from offerwise.operators.scoring import SoftmaxScorer, score_at_discounts
from offerwise.operators.value import best_offer
from offerwise.plans import training
from offerwise.plans.envelope import envelope_sensitivity
from offerwise.registry import inputs
from offerwise.registry.inputs import SCORER
from offerwise.schemas import FEATURES, PROBABILITIES

PRICING: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

FINE_ALPHAS = tuple(even_grid(0.0, 0.999, 1000))


def query(function):
    PRICING[function.__name__] = function
    return function


# --- the downgrade ratio ---------------------------------------------------------------


def _envelope(spark, sf_dir, **options) -> DataFrame:
    totals = envelope_sensitivity(inputs.cohort(spark, sf_dir), SCORER, **options)
    names = ("dynamic_value", "flat_value", "undiscounted_value")
    return totals.select("alpha", *[F.round(c, 2).alias(c) for c in names])


@query
def q_alpha_envelope_static(spark, sf_dir):
    return _envelope(spark, sf_dir, probs="static")


@query
def q_alpha_envelope_rescored(spark, sf_dir):
    return _envelope(spark, sf_dir, probs="rescored")


@query
def q_alpha_envelope_off_grid(spark, sf_dir):
    return _envelope(spark, sf_dir, probs="rescored", flat=0.12)


@query
def q_alpha_envelope_fine(spark, sf_dir):
    """A thousand ratios."""
    totals = envelope_sensitivity(inputs.cohort(spark, sf_dir), SCORER, FINE_ALPHAS, probs="rescored")
    return totals.select("alpha", F.round("dynamic_value", 1).alias("dynamic_value"))


# --- monotone scores -------------------------------------------------------------------


def rough_scores(df: DataFrame) -> DataFrame:
    """Fixed scores that jump up and down along the discounts."""
    step = F.round(F.col("simulated_discount") * 100).cast("bigint")
    churn = ((F.col("purchaseid") * 7 + step * 13) % 10) / F.lit(20.0)
    parts = {"p_accept": (1 - churn) * 0.75, "p_downgrade": (1 - churn) * 0.25, "p_churn": churn}
    return df.withColumns(parts)


@query
def q_monotone_scores(spark, sf_dir):
    """Churn at each discount, before and after pooling."""
    prepared = prepare_cohort(inputs.cohort(spark, sf_dir))
    scored = score_at_discounts(prepared, MonotoneScorer(rough_scores), GRID)
    rows = ", ".join(
        f"struct({i} AS scenario_id, round({a}, 6) AS p_accept, round({b}, 6) AS p_downgrade,"
        f" round({c}, 6) AS p_churn)"
        for i, (a, b, c) in enumerate(scored.p)
    )
    return scored.df.selectExpr("purchaseid", f"inline(array({rows}))")


@query
def q_monotone_offers(spark, sf_dir):
    offers = best_offer(inputs.cohort(spark, sf_dir), MonotoneScorer(rough_scores))
    return offers.select(
        "purchaseid",
        F.col("scenario_id").cast("int").alias("scenario_id"),
        F.round("p_churn", 6).alias("p_churn"),
    )


def _faults_of(scorer, cohort: DataFrame, family: str) -> DataFrame:
    scored = score_at_discounts(prepare_cohort(cohort), MonotoneScorer(scorer), GRID)
    falls = " + ".join(
        f"cast({scored.p[i][2]} < {scored.p[i + 1][2]} AS bigint)" for i in range(len(GRID) - 1)
    )
    sums = " + ".join(f"cast(abs({' + '.join(p)} - 1) > 1e-9 AS bigint)" for p in scored.p)
    return scored.df.selectExpr(f"{falls} AS falls", f"{sums} AS off").agg(
        F.lit(family).alias("family"),
        F.count(F.lit(1)).alias("rows"),
        F.sum("falls").alias("falling_steps"),
        F.sum("off").alias("sums_off_one"),
    )


@query
def q_monotone_faults(spark, sf_dir):
    """Churn that falls as the price rises, among the offers of pooled tree models."""
    cohort = inputs.cohort(spark, sf_dir)
    found = []
    for family in ("forest", "boosted"):
        model = fit_outcome_model(cohort, FEATURES, Learner(family))
        found.append(_faults_of(scorer_of(model), cohort, family))
    return reduce(DataFrame.unionByName, found)


# --- calibrated scores -----------------------------------------------------------------

# Two known models and their curves, so that calibrated offers can be computed in SQL as well.
CALIBRATED = CalibratedScorer(
    folds=(
        SCORER,
        SoftmaxScorer(
            features=("arpu", "arpu_trend"),
            coefficients=((0.0, 0.0), (0.0001, 0.0), (0.0004, 0.0002)),
            intercepts=(0.1, 0.0, 0.0),
        ),
    ),
    curves=(
        (Curve((0.1, 0.3, 0.30011, 0.7), (0.0, 0.2, 0.4, 0.9)), Curve((0.25,), (0.5,)), Curve((0.0, 1.0), (0.1, 0.8))),
        (Curve((0.2, 0.5), (0.1, 0.6)), Curve((0.1, 0.2, 0.4), (0.0, 0.0, 0.7)), Curve((0.35, 0.6), (0.2, 0.2))),
    ),
)


@query
def q_calibrated_fixed_scores(spark, sf_dir):
    scored = CALIBRATED(inputs.cohort(spark, sf_dir))
    return scored.select("purchaseid", *[F.round(p, 6).alias(p) for p in PROBABILITIES])


@query
def q_calibrated_fixed_offers(spark, sf_dir):
    offers = best_offer(inputs.cohort(spark, sf_dir), CALIBRATED)
    return offers.select(
        "purchaseid",
        F.col("scenario_id").cast("int").alias("scenario_id"),
        *[F.round(p, 6).alias(p) for p in PROBABILITIES],
        F.round("expected_value", 2).alias("expected_value"),
    )


# --- what moved a score ----------------------------------------------------------------


@query
def q_attribution(spark, sf_dir):
    cohort = inputs.cohort(spark, sf_dir)
    parts = attribution.attributions(cohort, SCORER, attribution.input_means(cohort, SCORER))
    return parts.select("purchaseid", "feature", *[F.round(c, 6).alias(c) for c in ("value", *attribution.OUTCOME_MARGINS)])


@query
def q_attribution_importance(spark, sf_dir):
    cohort = inputs.cohort(spark, sf_dir)
    parts = attribution.attributions(cohort, SCORER, attribution.input_means(cohort, SCORER))
    found = attribution.importance(parts)
    return found.select("feature", *[F.round(c, 6).alias(c) for c in attribution.OUTCOME_MARGINS])


@query
def q_attribution_reasons(spark, sf_dir):
    cohort = inputs.cohort(spark, sf_dir)
    means = attribution.input_means(cohort, SCORER)
    return attribution.reasons(cohort, SCORER, means).select(
        "purchaseid", F.array_join("reasons", ",").alias("reasons")
    )


@query
def q_attribution_faults(spark, sf_dir):
    """Rows of a fitted model whose parts do not add up to the log odds that it gives."""
    cohort = inputs.cohort(spark, sf_dir)
    scorer = scorer_of(fit_outcome_model(cohort, FEATURES, training.PRODUCTION))
    means = attribution.input_means(cohort, scorer)
    accept, _, churn = attribution.mean_margins(scorer, means)
    parts = attribution.attributions(cohort, scorer, means)
    sums = parts.groupBy("purchaseid").agg(
        F.sum(F.col("churn") - F.col("accept")).alias("pull"), F.count("*").alias("features")
    )
    odds = scorer(cohort).select("purchaseid", F.ln(F.col("p_churn") / F.col("p_accept")).alias("odds"))
    off = F.abs(F.col("pull") + (churn - accept) - F.col("odds")) > 1e-6 * (1 + F.abs("odds"))
    return sums.join(odds, "purchaseid").agg(
        F.count("*").alias("rows"), F.count_if(off).alias("off"), F.sum("features").alias("parts")
    )
