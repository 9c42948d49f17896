"""Fitting outcome models; every fitted model is a plain Spark ML pipeline."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerwise.operators.calibrated import CalibratedScorer, Curve, addressable
from offerwise.operators.scenarios import align_features
from offerwise.operators.scoring import (
    MISSING,
    ModelScorer,
    Scorer,
    SoftmaxScorer,
    model_input,
)
from offerwise.schemas import LABEL, MISSABLE, OUTCOMES

INPUT = "x_"
# Rows that models are fitted on: in a partition, and for each core in all fits at a time. A row
# takes some 150 bytes in a linear fit, 600 in a forest.
ROWS_PER_PARTITION = 250_000
ROWS_HELD_PER_CORE = 1_000_000
SPLITS = "spark.sql.files.minPartitionNum"
UNBOUNDED = 1e100  # a saved model cannot hold infinite bounds

# Light shrinkage keeps coefficients finite on separable data.
DEFAULTS = {
    "logistic": {"maxIter": 100, "regParam": 1e-3, "tol": 1e-5},
    "forest": {"numTrees": 100, "maxDepth": 5, "seed": 42},
    # Checkpoints write every row's error: worth it in long runs only.
    "boosted": {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1, "seed": 42, "checkpointInterval": 25},
}


@dataclass(frozen=True)
class Learner:
    """How to fit three-state outcome probabilities.

    family: 'logistic' (multinomial; the only one that honours
    `rising_with_price`), 'forest', or 'boosted' (one boosted classifier per
    outcome against the rest, normalised).
    rising_with_price: features in which churn may only rise.
    """

    family: str = "logistic"
    rising_with_price: tuple[str, ...] = ()
    params: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.family not in DEFAULTS:
            raise ValueError(f"unknown family {self.family!r}")
        if self.rising_with_price and self.family != "logistic":
            raise ValueError("only the logistic family can be constrained")

    def classifiers(
        self, inputs: Sequence[str], weight: str | None = None, suffix: str = ""
    ) -> list[Estimator]:
        """Untrained classifiers over the vector of `inputs`, in outcome order."""
        settings = DEFAULTS[self.family] | self.params
        if weight:
            settings["weightCol"] = weight
        if self.family == "boosted":
            return [
                _name_outputs(GBTClassifier(labelCol=f"is_{k}", **settings), f"{suffix}_{k}")
                for k in OUTCOMES
            ]
        if self.family == "forest":
            return [_name_outputs(RandomForestClassifier(**settings), suffix)]
        logistic = LogisticRegression(family="multinomial", **settings)
        if any(f in self.rising_with_price for f in inputs):
            logistic = _constrain(logistic, inputs, self.rising_with_price)
        return [_name_outputs(logistic, suffix)]


def _name_outputs(classifier, suffix: str):
    return (
        classifier.setRawPredictionCol(f"rawPrediction{suffix}")
        .setProbabilityCol(f"probability{suffix}")
        .setPredictionCol(f"prediction{suffix}")
    )


def _constrain(
    logistic: LogisticRegression, inputs: Sequence[str], rising: Sequence[str]
) -> LogisticRegression:
    """Bound coefficients so that P(churn) cannot fall as any `rising` feature grows.

    dP(churn)/dx = P(churn) * (b_churn - sum P_k b_k), which is never negative
    if b_churn >= 0 and the other outcomes' coefficients are <= 0.
    """
    churn = OUTCOMES[-1]
    low, high = [], []
    for feature in inputs:  # matrices are column-major: one column per input
        for k in OUTCOMES:
            bound = feature in rising
            low.append(0.0 if bound and k == churn else -UNBOUNDED)
            high.append(0.0 if bound and k != churn else UNBOUNDED)
    shape = (len(OUTCOMES), len(inputs))
    return logistic.setLowerBoundsOnCoefficients(
        DenseMatrix(*shape, low)
    ).setUpperBoundsOnCoefficients(DenseMatrix(*shape, high))


def model_inputs(features: Sequence[str]) -> list[str]:
    """Features plus a missing-value flag for those that can be NULL."""
    return [*features, *[f + MISSING for f in features if f in MISSABLE]]


def input_stages(features: Sequence[str]) -> list:
    """Stages from raw features to the vector: NULL and NaN become 0, flagged where expected."""
    terms = [f"{model_input(n)} AS `{INPUT}{n}`" for n in model_inputs(features)]
    return [
        SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__"),
        VectorAssembler(
            inputCols=[INPUT + n for n in model_inputs(features)], outputCol="features"
        ),
    ]


@contextmanager
def training_vectors(
    train: DataFrame, features: Sequence[str], keep: Sequence[str] = (), label: str = LABEL
) -> Iterator[DataFrame]:
    """Vectors, label, one 0/1 column per outcome and `keep`, held while models are fitted."""
    # Every iteration is a job over all partitions: one for each core at least, but not many
    # near-empty ones more.
    spark = train.sparkSession
    cores = spark.sparkContext.defaultParallelism
    partitions = max(cores, math.ceil(train.count() / ROWS_PER_PARTITION))
    df = align_features(train, features)
    for stage in input_stages(features):
        df = stage.transform(df)
    df = df.select(
        "features",
        F.col(label).cast("double").alias("label"),
        *[(F.col(label) == k).cast("double").alias(f"is_{k}") for k in OUTCOMES],
        *keep,
    )
    df = df.coalesce(partitions).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if partitions > cores:
            _read_in(spark, df, partitions)
        yield df
    finally:
        df.unpersist()


def _read_in(spark: SparkSession, df: DataFrame, partitions: int) -> None:
    """Fill a held table from files cut into so many parts.

    Spark cuts files of up to 128 MB a core for each core: a partition would grow with the table.
    """
    before = spark.conf.get(SPLITS, None)
    spark.conf.set(SPLITS, str(partitions))
    try:
        df.count()
    finally:
        spark.conf.unset(SPLITS) if before is None else spark.conf.set(SPLITS, before)


def fits_at_once(vectors: DataFrame, most: int) -> int:
    """How many fits to run at a time: each holds its rows in memory, in a form of its own.

    Two at least, so that one uses the cores that the other leaves idle between its jobs.
    """
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    return min(most, max(2, cores * ROWS_HELD_PER_CORE // max(1, vectors.count())))


def assemble_model(features: Sequence[str], fitted: Sequence) -> PipelineModel:
    return PipelineModel(stages=[*input_stages(features), *fitted])


def fit_outcome_model(
    train: DataFrame,
    features: Sequence[str],
    learner: Learner = Learner(),
    weight: str | None = None,
) -> PipelineModel:
    """Fit three-state outcome probabilities on labelled rows."""
    classifiers = learner.classifiers(model_inputs(features), weight)
    with training_vectors(train, features, [weight] if weight else []) as vectors:
        fitted = Pipeline(stages=classifiers).fit(vectors).stages
    return assemble_model(features, fitted)


def fit_churn_model(
    train: DataFrame, features: Sequence[str], family: str = "boosted", **params: object
) -> PipelineModel:
    """Fit a binary churn model: churned (label 2) against the rest. `params` change DEFAULTS."""
    settings = DEFAULTS[family] | params
    if family == "boosted":
        classifier = GBTClassifier(labelCol="is_2", **settings)
    else:
        classifier = LogisticRegression(labelCol="is_2", family="binomial", **settings)
    with training_vectors(train, features) as vectors:
        fitted = classifier.fit(vectors)
    return assemble_model(features, [fitted])


def churn_risk(model: PipelineModel, df: DataFrame, name: str = "churn_risk") -> DataFrame:
    """Add a binary model's churn probability."""
    scored = model.transform(align_features(df, model_features(model)))
    risk = F.get(vector_to_array("probability"), F.lit(1))
    return scored.withColumn(name, risk).select(*df.columns, name)


def model_features(model: PipelineModel) -> list[str]:
    """The features a fitted pipeline reads, in training order."""
    names = [c.removeprefix(INPUT) for c in model.stages[1].getInputCols()]
    return [n for n in names if not n.endswith(MISSING)]


def scorer_of(model: PipelineModel) -> Scorer:
    """The cheapest scorer for a fitted model: column arithmetic if it is linear, calibrated or not."""
    last = model.stages[-1]
    features = model_features(model)
    inputs = tuple(model_inputs(features))
    if isinstance(last, LogisticRegressionModel):
        return softmax_scorer(last, inputs)
    linear = [s for s in model.stages if isinstance(s, LogisticRegressionModel)]
    curves = [s for s in model.stages if isinstance(s, IsotonicRegressionModel)]
    knots = [c.boundaries.toArray() for c in curves]
    if not linear or len(curves) != len(OUTCOMES) * len(linear) or not all(map(addressable, knots)):
        return ModelScorer(model, tuple(features))
    return CalibratedScorer(
        folds=tuple(softmax_scorer(fold, inputs) for fold in linear),
        # A fold's curves follow it, in outcome order.
        curves=tuple(
            tuple(_curve(c) for c in curves[f : f + len(OUTCOMES)])
            for f in range(0, len(curves), len(OUTCOMES))
        ),
    )


def softmax_scorer(model: LogisticRegressionModel, inputs: Sequence[str]) -> SoftmaxScorer:
    """A fitted model as column arithmetic over `inputs`, the entries of its vector."""
    return SoftmaxScorer(
        features=tuple(inputs),
        coefficients=tuple(tuple(r) for r in model.coefficientMatrix.toArray().tolist()),
        intercepts=tuple(model.interceptVector.toArray().tolist()),
    )


def _curve(model: IsotonicRegressionModel) -> Curve:
    return Curve(tuple(model.boundaries.toArray().tolist()), tuple(model.predictions.toArray().tolist()))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)
