"""Registered jobs that fit models. Their results have no closed form in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerwise.models import (
    Learner,
    calibrate,
    fit_outcome_model,
    load_model,
    save_model,
    scorer_of,
    tune,
)
from offerwise.operators.metrics import with_class_weights
from offerwise.operators.value import best_offer
from offerwise.plans import audit, external, prescription, training
from offerwise.registry import inputs
from offerwise.schemas import FEATURES, LABEL, PROBABILITIES
from offerwise.session import scratch_path

MODEL_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    MODEL_QUERIES[function.__name__] = function
    return function


def _scores(spark, sf_dir, model) -> DataFrame:
    scored = scorer_of(model)(inputs.cohort(spark, sf_dir))
    return scored.select("purchaseid", LABEL, *[F.round(p, 6).alias(p) for p in PROBABILITIES])


def _fit(spark, sf_dir, learner, weight=None):
    rows = inputs.cohort(spark, sf_dir)
    if weight:
        rows = with_class_weights(rows)
    return fit_outcome_model(rows, FEATURES, learner, weight)


@query
def q_logistic_scores(spark, sf_dir):
    return _scores(spark, sf_dir, _fit(spark, sf_dir, Learner()))


@query
def q_constrained_scores(spark, sf_dir):
    return _scores(spark, sf_dir, _fit(spark, sf_dir, training.PRODUCTION, "class_weight"))


@query
def q_forest_scores(spark, sf_dir):
    return _scores(spark, sf_dir, _fit(spark, sf_dir, Learner("forest"), "class_weight"))


@query
def q_boosted_scores(spark, sf_dir):
    return _scores(spark, sf_dir, _fit(spark, sf_dir, Learner("boosted")))


@query
def q_tuning(spark, sf_dir):
    """Log loss of each drawn setting."""
    rows = with_class_weights(inputs.cohort(spark, sf_dir))
    _, results = tune(rows, FEATURES, training.PRODUCTION, "class_weight")
    return spark.createDataFrame(
        [(s["regParam"], s["maxIter"], s["standardization"], loss) for s, loss in results],
        "reg_param double, max_iter int, standardization boolean, log_loss double",
    )


@query
def q_calibrated_scores(spark, sf_dir):
    rows = with_class_weights(inputs.cohort(spark, sf_dir))
    model = calibrate(rows, FEATURES, training.PRODUCTION, "class_weight")
    return _scores(spark, sf_dir, model)


@query
def q_model_roundtrip(spark, sf_dir):
    """Scores of a calibrated model after saving and loading it."""
    rows = with_class_weights(inputs.cohort(spark, sf_dir))
    path = scratch_path(spark, "model")
    save_model(calibrate(rows, FEATURES, training.PRODUCTION, "class_weight"), path)
    return _scores(spark, sf_dir, load_model(path))


@query
def q_train_report(spark, sf_dir):
    return inputs.training_run(spark, sf_dir).report


@query
def q_retrained_offers(spark, sf_dir):
    model = training.retrain(inputs.mart(spark, sf_dir), scratch_path(spark, "production-model"))
    offers = best_offer(inputs.cohort(spark, sf_dir), scorer_of(model))
    return prescription.target_list(offers)


@query
def q_calibrated_offers(spark, sf_dir):
    """Recommended discounts of a calibrated model."""
    rows = with_class_weights(inputs.cohort(spark, sf_dir))
    model = calibrate(rows, FEATURES, training.PRODUCTION, "class_weight")
    offers = best_offer(inputs.cohort(spark, sf_dir), scorer_of(model))
    return prescription.discount_distribution(offers)


@query
def q_ablation(spark, sf_dir):
    return training.ablation(inputs.mart(spark, sf_dir))


@query
def q_constraint_audit(spark, sf_dir):
    return audit.constraint_audit(inputs.mart(spark, sf_dir), sample=None)


@query
def q_strategy_models(spark, sf_dir):
    """Policies of a fitted binary and a fitted three-state model."""
    return training.compare_policies(inputs.mart(spark, sf_dir))


@query
def q_external_policy(spark, sf_dir):
    return external.external_run(inputs.churn_export(spark, sf_dir))
