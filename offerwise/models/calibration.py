"""Isotonic calibration of outcome probabilities over cross-fitted folds."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerwise.functions import hash_bucket
from offerwise.models.fitting import (
    Learner,
    assemble_model,
    fits_at_once,
    model_inputs,
    training_vectors,
)
from offerwise.models.tuning import FOLDS, fold_of
from offerwise.operators.calibrated import BINS
from offerwise.schemas import OUTCOMES, PROBABILITIES
from offerwise.session import store

# The isotonic merge is not distributed, so it sees scores in BINS bins: at most one point in
# each per outcome, with the weight of its rows.


def calibrate(
    train: DataFrame,
    features: Sequence[str],
    learner: Learner = Learner(),
    weight: str | None = None,
    key: str = "purchaseid",
    folds: int = FOLDS,
    bucket: Callable[[Column, int, int], Column] = hash_bucket,
) -> PipelineModel:
    """A pipeline of one model per fold, each calibrated on the rows it has not seen.

    Per fold and outcome, scores are mapped through an isotonic fit against
    that outcome and normalised over the outcomes; the folds are averaged.
    `bucket` deals rows over the folds by their key.
    """
    placed = train.withColumn("fold", fold_of(F.col(key), folds, bucket=bucket))
    kept = ["fold", *([weight] if weight else [])]

    def fit_fold(fold: int) -> PipelineModel:
        classifiers = learner.classifiers(model_inputs(features), weight, f"_{fold}")
        return Pipeline(stages=classifiers).fit(vectors.where(F.col("fold") != fold))

    with training_vectors(placed, features, kept) as vectors:
        at_once = fits_at_once(vectors, folds)
        models = _side_by_side(train.sparkSession, fit_fold, range(folds), at_once)
        scored = [
            _binned(fitted.transform(vectors.where(F.col("fold") == fold)), learner, fold, weight)
            for fold, fitted in enumerate(models)
        ]
        points = store(reduce(DataFrame.unionByName, scored), "calibration-points")

    def fit_isotonic(target: tuple[int, int]):
        fold, k = target
        column, index = _score_column(learner, fold, k)
        isotonic = IsotonicRegression(
            featuresCol="score", labelCol="share", weightCol="weight",
            predictionCol=f"calibrated_{fold}_{k}",
        ).fit(points.where((F.col("fold") == fold) & (F.col("outcome") == k)))
        return isotonic.setFeaturesCol(column).setFeatureIndex(index)

    targets = [(fold, k) for fold in range(folds) for k in OUTCOMES]
    curves = dict(
        zip(targets, _side_by_side(train.sparkSession, fit_isotonic, targets), strict=True)
    )
    stages = []
    for fold, fitted in enumerate(models):
        stages += [*fitted.stages, *[curves[fold, k] for k in OUTCOMES]]
    return assemble_model(features, [*stages, _average(folds)])


def _side_by_side(
    spark: SparkSession, fit: Callable, items: Iterable, at_once: int | None = None
) -> list:
    """Independent fits, run at the same time so that their jobs share the executors."""
    tasks = [inheritable_thread_target(spark)(partial(fit, item)) for item in items]
    with ThreadPoolExecutor(at_once or len(tasks)) as pool:
        return list(pool.map(lambda task: task(), tasks))


def _score_column(learner: Learner, fold: int, outcome: int) -> tuple[str, int]:
    """The probability vector that scores an outcome, and the position in it."""
    if learner.family == "boosted":
        return f"probability_{fold}_{outcome}", 1
    return f"probability_{fold}", outcome


def _binned(held_out: DataFrame, learner: Learner, fold: int, weight: str | None) -> DataFrame:
    """Per outcome and score bin: mean score, share of the outcome and weight."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    entries = []
    for k in OUTCOMES:
        column, index = _score_column(learner, fold, k)
        entries.append(
            F.struct(
                F.lit(k).alias("outcome"),
                F.get(vector_to_array(column), F.lit(index)).alias("score"),
                F.col(f"is_{k}").alias("hit"),
            )
        )
    long = held_out.select(w.alias("w"), F.inline(F.array(*entries)))
    by_bin = long.groupBy("outcome", F.round(F.col("score") * BINS).alias("bin")).agg(
        F.sum("w").alias("weight"),
        F.sum(F.col("w") * F.col("score")).alias("scores"),
        F.sum(F.col("w") * F.col("hit")).alias("hits"),
    )
    return by_bin.where(F.col("weight") > 0).select(
        F.lit(fold).alias("fold"),
        "outcome",
        (F.col("scores") / F.col("weight")).alias("score"),
        (F.col("hits") / F.col("weight")).alias("share"),
        "weight",
    )


def _average(folds: int) -> SQLTransformer:
    """Normalise each fold over the outcomes (equal shares if all are 0), then average."""
    terms = []
    for k, name in zip(OUTCOMES, PROBABILITIES, strict=True):
        shares = []
        for fold in range(folds):
            total = " + ".join(f"calibrated_{fold}_{j}" for j in OUTCOMES)
            shares.append(
                f"CASE WHEN {total} > 0 THEN calibrated_{fold}_{k} / ({total})"
                f" ELSE {1 / len(OUTCOMES)!r}D END"
            )
        terms.append(f"({' + '.join(shares)}) / {folds} AS {name}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__")
