"""Random search over a learner's settings, judged by cross-validated log loss."""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerwise.functions import hash_bucket
from offerwise.models.fitting import (
    Learner,
    fits_at_once,
    model_inputs,
    softmax_scorer,
    training_vectors,
)
from offerwise.operators.metrics import log_loss
from offerwise.operators.scoring import SoftmaxScorer, with_given, with_probabilities

# The settings searched, how many are drawn, and the folds.
SEARCH_SPACE = {
    "logistic": {
        "regParam": [0.0001, 0.001, 0.01, 0.1],
        "maxIter": [50, 100, 200],
        "standardization": [True, False],
    },
    "forest": {
        "numTrees": [100, 200, 300],
        "maxDepth": [3, 5, 7],
        "subsamplingRate": [0.7, 0.8, 1.0],
        "featureSubsetStrategy": ["0.7", "0.8", "all"],
        "minInstancesPerNode": [1, 3, 5],
    },
    "boosted": {
        "maxIter": [100, 200, 300],
        "maxDepth": [3, 5, 7],
        "stepSize": [0.01, 0.05, 0.1, 0.2],
        "subsamplingRate": [0.7, 0.8, 1.0],
        "featureSubsetStrategy": ["0.7", "0.8", "all"],
        "minInstancesPerNode": [1, 3, 5],
    },
}
DRAWS = 15
FOLDS = 3


def fold_of(
    key: Column,
    folds: int = FOLDS,
    seed: int = 7,
    bucket: Callable[[Column, int, int], Column] = hash_bucket,
) -> Column:
    """Fold of a row by a hash of its key."""
    return bucket(key, seed, folds).cast("int")


class OutcomeLogLoss(Evaluator):
    """Log loss of the three outcome probabilities, whatever the family."""

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = with_probabilities(dataset)
        loss = scored.agg(log_loss(F.col("label"))).first()[0]
        return math.nan if loss is None else loss

    def isLargerBetter(self) -> bool:
        return False


def draw_settings(space: dict[str, Sequence], draws: int, seed: int) -> list[dict]:
    """`draws` distinct combinations of a search space, or all if there are fewer."""
    combinations = [
        dict(zip(space, values, strict=True)) for values in itertools.product(*space.values())
    ]
    return random.Random(seed).sample(combinations, min(draws, len(combinations)))


def _cross_validated(
    vectors: DataFrame, estimator: Pipeline, maps: list[dict], folds: int, parallelism: int
) -> list[float]:
    """Mean log loss of each setting over the folds. Nothing is refitted on all rows.

    Linear models of a fold are judged together, in one pass over its held-out rows; others
    each in a job of their own.
    """
    evaluator = OutcomeLogLoss()
    linear = all(isinstance(s, LogisticRegression) for s in estimator.getStages())

    def held_out(fold: int) -> DataFrame:
        return vectors.where(F.col("fold") == fold)

    def judged(task: tuple[int, list[int]]) -> list[SoftmaxScorer | float]:
        fold, chain = task
        rows = vectors.where(F.col("fold") != fold)
        if linear:
            return [
                softmax_scorer(m, [f"x{j}" for j in range(m.numFeatures)])
                for m in _fitted_chain(rows, estimator, [maps[i] for i in chain])
            ]
        return [evaluator.evaluate(estimator.fit(rows, maps[i]).transform(held_out(fold))) for i in chain]

    chains = _chains(maps) if linear else [[i] for i in range(len(maps))]
    tasks = [(fold, chain) for fold in range(folds) for chain in chains]
    run = [inheritable_thread_target(vectors.sparkSession)(partial(judged, task)) for task in tasks]
    with ThreadPoolExecutor(min(parallelism, len(run))) as pool:
        judgements = list(pool.map(lambda task: task(), run))
    by_fold = [[None] * len(maps) for _ in range(folds)]
    for (fold, chain), found in zip(tasks, judgements, strict=True):
        for i, one in zip(chain, found, strict=True):
            by_fold[fold][i] = one
    if linear:
        by_fold = [linear_losses(held_out(f), scorers) for f, scorers in enumerate(by_fold)]
    return [sum(losses) / folds for losses in zip(*by_fold, strict=True)]


def _iterations(settings: dict) -> int:
    return next((v for p, v in settings.items() if p.name == "maxIter"), 0)


def _chains(maps: list[dict]) -> list[list[int]]:
    """Places of the settings that differ in nothing but the iterations allowed, fewest first."""
    chains: dict[frozenset, list[int]] = {}
    for i in sorted(range(len(maps)), key=lambda i: _iterations(maps[i])):
        rest = frozenset((p.name, v) for p, v in maps[i].items() if p.name != "maxIter")
        chains.setdefault(rest, []).append(i)
    return list(chains.values())


def _fitted_chain(
    rows: DataFrame, estimator: Pipeline, chain: list[dict]
) -> list[LogisticRegressionModel]:
    """A linear model for each setting of a chain.

    A fit that ended before its last iteration takes the same steps when more are allowed, so
    its model is theirs too.
    """
    models = []
    settled = False
    for settings in chain:
        if not settled:
            model = estimator.fit(rows, settings).stages[0]
            # The history starts with the value before the first iteration.
            settled = len(model.summary.objectiveHistory) <= model.getMaxIter()
        models.append(model)
    return models


def linear_losses(vectors: DataFrame, scorers: Sequence[SoftmaxScorer]) -> list[float]:
    """Log loss of each model on the same rows (features, label): one job, one row of losses.

    Models read the entries of the vector as x0, x1 and so on.
    """
    entries = [F.get("_entries", F.lit(j)).alias(f) for j, f in enumerate(scorers[0].features)]
    rows = vectors.select("label", vector_to_array("features").alias("_entries"))
    df = rows.select("label", *entries)
    names = [f"_given_{i}" for i in range(len(scorers))]
    df = with_given(df, scorers, names)
    losses = df.agg(
        *[log_loss(F.col("label"), [F.col(n)] * 3).alias(n) for n in names]
    ).first()
    return [math.nan if loss is None else loss for loss in losses]


def tune(
    train: DataFrame,
    features: Sequence[str],
    learner: Learner = Learner(),
    weight: str | None = None,
    key: str = "purchaseid",
    space: dict[str, Sequence] | None = None,
    draws: int = DRAWS,
    folds: int = FOLDS,
    seed: int = 42,
    parallelism: int | None = None,
) -> tuple[Learner, list[tuple[dict, float]]]:
    """The learner with the best settings, and every drawn setting with its log loss.

    `parallelism` is how many fits run at a time: by default as many as there are cores, but no
    more than memory holds the rows of (see `fits_at_once`).
    """
    cores = train.sparkSession.sparkContext.defaultParallelism
    settings = draw_settings(space or SEARCH_SPACE[learner.family], draws, seed)
    classifiers = learner.classifiers(model_inputs(features), weight)
    maps = [
        {c.getParam(name): value for c in classifiers for name, value in drawn.items()}
        for drawn in settings
    ]
    kept = ["fold", *([weight] if weight else [])]
    placed = train.withColumn("fold", fold_of(F.col(key), folds))
    with training_vectors(placed, features, kept) as vectors:
        side_by_side = parallelism or fits_at_once(vectors, cores)
        losses = _cross_validated(vectors, Pipeline(stages=classifiers), maps, folds, side_by_side)
    results = list(zip(settings, losses, strict=True))
    finite = [r for r in results if math.isfinite(r[1])]
    if not finite:
        raise ValueError("no drawn setting gave a finite log loss")
    best = min(finite, key=lambda r: r[1])[0]
    return Learner(learner.family, learner.rising_with_price, learner.params | best), results
