"""Models published in versions: a failed write leaves the current one as it is."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from offerwise.models.fitting import model_features
from offerwise.sources.versions import (
    complete,
    current_version,
    make_current,
    manifests,
    next_version,
    version_path,
)


def publish(
    spark: SparkSession, model: PipelineModel, path: str, metrics: Mapping[str, float] | None = None
) -> int:
    """Write a model as a new version and make it the current one; its number.

    The manifest holds its features, its stages and `metrics`. Nothing that is there is
    touched: until the last small file is renamed, `load_model` gives the version before.
    """
    version = next_version(spark, path)
    model.write().save(f"{version_path(path, version)}/model")
    facts = {
        "features": model_features(model),
        "stages": [type(stage).__name__ for stage in model.stages],
        "metrics": dict(metrics or {}),
    }
    complete(spark, path, version, facts)
    return version


def load_model(path: str, version: int | None = None) -> PipelineModel:
    """The current version of a published model, or the one named; a plain saved model also."""
    spark = SparkSession.active()
    found = current_version(spark, path) if version is None else version
    return PipelineModel.load(path if found is None else f"{version_path(path, found)}/model")


def roll_back(spark: SparkSession, path: str, version: int) -> None:
    """Make an earlier complete version the current one again."""
    make_current(spark, path, version)


def model_versions(spark: SparkSession, path: str) -> DataFrame:
    """(version, current, features, metrics) of the complete versions."""
    now = current_version(spark, path)
    rows = [(m["version"], m["version"] == now, m["features"], m["metrics"]) for m in manifests(spark, path)]
    return spark.createDataFrame(
        rows, "version int, current boolean, features array<string>, metrics map<string, double>"
    )
