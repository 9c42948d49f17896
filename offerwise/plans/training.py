"""What models train on, and the training jobs."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwise.models import (
    Learner,
    calibrate,
    churn_risk,
    fit_churn_model,
    fit_outcome_model,
    publish,
    scorer_of,
    tune,
)
from offerwise.operators.metrics import (
    class_report,
    improvement_percent,
    log_loss,
    macro_f1,
    value_shares,
    with_class_weights,
)
from offerwise.operators.scoring import hard_prediction
from offerwise.operators.splits import split, stratified_split
from offerwise.plans.strategy import strategy_comparison
from offerwise.schemas import (
    LABEL,
    LATENT_FEATURES,
    NON_FEATURES,
    PRICE_FEATURES,
    PROBABILITIES,
    feature_columns,
    require_columns,
)
from offerwise.session import store

PRODUCTION = Learner(rising_with_price=PRICE_FEATURES)


def labelled(mart: DataFrame) -> DataFrame:
    """Rows whose outcome is known, with the label as int."""
    require_columns(mart, [LABEL], "mart")
    return mart.where(F.col(LABEL).isNotNull()).withColumn(LABEL, F.col(LABEL).cast("int"))


def training_set(mart: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Labelled rows without ids and text columns; `keep` names ids needed for a split."""
    return labelled(mart).drop(*[c for c in NON_FEATURES if c not in keep])


def class_distribution(mart: DataFrame) -> DataFrame:
    return value_shares(labelled(mart), LABEL)


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


@dataclass(frozen=True)
class TrainingRun:
    """A calibrated model, how it was found, and how it does on unseen rows."""

    model: PipelineModel
    learner: Learner
    search: list[tuple[dict, float]]
    report: DataFrame


def train(
    mart: DataFrame,
    learner: Learner = PRODUCTION,
    key: str = "purchaseid",
    path: str | None = None,
    **search: object,
) -> TrainingRun:
    """Split, weight, tune, calibrate, evaluate and (with `path`) publish an outcome model.

    `search` goes to `tune`: draws, folds, parallelism, space. The split rows
    are stored once, since every later step reads them.
    """
    rows = labelled(mart)
    features = feature_columns(rows)
    placed = store(stratified_split(rows, LABEL, key), "training-rows")
    fitting = with_class_weights(placed.where("in_train").drop("in_train"))
    unseen = placed.where(~F.col("in_train")).drop("in_train")
    best, results = tune(fitting, features, learner, "class_weight", key, **search)
    model = calibrate(fitting, features, best, "class_weight", key)
    predicted = scorer_of(model)(unseen).withColumn("prediction", hard_prediction())
    report = class_report(predicted)
    if path:
        quality = {r["class"]: r["f1"] for r in report.collect()}
        publish(mart.sparkSession, model, path, {"search_log_loss": min(r[1] for r in results)} | {
            f"f1 {name}": f1 for name, f1 in quality.items()
        })
    return TrainingRun(model, best, results, report)


def retrain(mart: DataFrame, path: str, learner: Learner = PRODUCTION) -> PipelineModel:
    """Refit the price-constrained model on all labelled rows and publish it."""
    rows = labelled(mart)
    model = fit_outcome_model(rows, feature_columns(rows), learner)
    publish(mart.sparkSession, model, path)
    return model


def ablation(
    mart: DataFrame,
    latent: Sequence[str] = LATENT_FEATURES,
    learner: Learner = Learner(),
    key: str = "purchaseid",
) -> DataFrame:
    """Model quality without and with the derived discount features, and the gain in percent."""
    rows = labelled(mart)
    features = feature_columns(rows)
    dropped = [f for f in latent if f in features]
    if not dropped:
        warnings.warn("no latent discount feature in the input", stacklevel=2)
    fitting, unseen = split(rows, key)
    variants = {
        "baseline": [f for f in features if f not in dropped],
        "enhanced": features,
    }
    scored = unseen
    for name, chosen in variants.items():
        scored = scorer_of(fit_outcome_model(fitting, chosen, learner))(scored)
        scored = scored.withColumn(f"{name}_guess", hard_prediction()).withColumnsRenamed(
            {p: f"{name}_{p}" for p in PROBABILITIES}
        )
    label = F.col(LABEL)
    quality = scored.agg(
        *[macro_f1(label, F.col(f"{n}_guess")).alias(f"{n}_f1") for n in variants],
        *[
            log_loss(label, [F.col(f"{n}_{p}") for p in PROBABILITIES]).alias(f"{n}_loss")
            for n in variants
        ],
    )
    f1_gain = improvement_percent(F.col("baseline_f1"), F.col("enhanced_f1"))
    loss_gain = improvement_percent(
        F.col("baseline_loss"), F.col("enhanced_loss"), lower_is_better=True
    )
    nothing = F.lit(None).cast("double")
    return quality.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("model"),
                        F.col(f"{n}_f1").alias("macro_f1"),
                        F.col(f"{n}_loss").alias("log_loss"),
                        (f1_gain if n == "enhanced" else nothing).alias("f1_gain_percent"),
                        (loss_gain if n == "enhanced" else nothing).alias("loss_gain_percent"),
                    )
                    for n in variants
                ]
            )
        )
    )


def compare_policies(
    mart: DataFrame,
    learner: Learner = Learner(),
    probs: str = "static",
    key: str = "purchaseid",
) -> DataFrame:
    """Fit the binary and the three-state model on one split and compare their policies."""
    rows = labelled(mart)
    features = feature_columns(rows)
    fitting, unseen = split(rows, key)
    binary = fit_churn_model(fitting, features)
    outcome = scorer_of(fit_outcome_model(fitting, features, learner))
    return strategy_comparison(
        churn_risk(binary, unseen), outcome, risk="churn_risk", probs=probs
    )
