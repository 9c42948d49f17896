"""What must not grow with the tables: fits, partitions and files."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from offerwise import session
from offerwise.models import Learner, fitting, tuning
from offerwise.models.fitting import fits_at_once, model_inputs, training_vectors
from offerwise.plans import incremental
from offerwise.plans.mart import build_mart
from offerwise.registry import inputs
from offerwise.sources.quarantine import read_checked_cohort

FEATURES = ["arpu", "duration"]


def labelled_rows(spark, n):
    noise = F.xxhash64("id") % 100
    return spark.range(0, n, 1, 2).select(
        F.col("id").alias("purchaseid"),
        ((F.col("id") % 3).cast("double") + noise / 50).alias("arpu"),
        (noise % 7).cast("int").alias("duration"),
        (F.col("id") % 3).cast("int").alias("customer_action"),
        (F.col("id") % 2).cast("int").alias("fold"),
    )


@pytest.mark.parametrize("enough", [True, False])
def test_settled_fits_are_shared(spark, enough):
    """Same losses as fitted one by one, and only fits that ran out of iterations are repeated."""
    learner = Learner()
    iterations = [100, 50, 200] if enough else [3, 1, 2]
    (classifier,) = learner.classifiers(model_inputs(FEATURES))
    maps = [{classifier.maxIter: m, classifier.regParam: r} for r in (0.0001, 0.1) for m in iterations]
    fitted = []

    class Counting(Pipeline):
        def fit(self, rows, settings):
            fitted.append(settings)
            return super().fit(rows, settings)

    with training_vectors(labelled_rows(spark, 300), FEATURES, ["fold"]) as vectors:
        shared = tuning._cross_validated(vectors, Counting(stages=[classifier]), maps, 2, 2)
        count = len(fitted)
        alone = [tuning._cross_validated(vectors, Pipeline(stages=[classifier]), [m], 2, 2)[0] for m in maps]
    assert shared == pytest.approx(alone, abs=1e-12)
    assert count == (4 if enough else 12)


def test_partitions_of_fits_stay_small(spark, tmp_path, monkeypatch):
    """A table of many files, which Spark would read in one partition a core."""
    monkeypatch.setattr(fitting, "ROWS_PER_PARTITION", 100)
    monkeypatch.setattr(session, "ROWS_PER_FILE", 100)
    rows = session.store(labelled_rows(spark, 4000), "many-rows")
    # As if each core read 4 MB or more in one go.
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        with training_vectors(rows, FEATURES) as vectors:
            sizes = vectors.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sizes <= 200
    assert spark.conf.get(fitting.SPLITS, None) is None


def test_fits_at_once_are_bounded_by_rows(spark, monkeypatch):
    rows = spark.range(1000)
    assert fits_at_once(rows, 45) == 45
    monkeypatch.setattr(fitting, "ROWS_HELD_PER_CORE", 500)
    assert fits_at_once(rows, 45) == 4
    monkeypatch.setattr(fitting, "ROWS_HELD_PER_CORE", 1)
    assert fits_at_once(rows, 45) == 2


def test_stored_files_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_FILE", 10)
    path = session.store(spark.range(0, 95, 1, 1), "small-files").inputFiles()[0]
    files = glob.glob(os.path.join(os.path.dirname(path.removeprefix("file://")), "*.parquet"))
    assert sorted(pq.ParquetFile(f).metadata.num_rows for f in files) == [5] + [10] * 9


def stored_names(spark):
    return [os.path.basename(p) for p in session._paths.get(spark.sparkContext.applicationId, [])]


def test_first_batch_is_written_once(spark, tmp_path):
    log = purchase_log(spark, 40)
    before = len(stored_names(spark))
    incremental.append_batch(log.where("purchaseid < 30"), str(tmp_path / "mart"), "2024-03-01")
    assert not [n for n in stored_names(spark)[before:] if n.startswith("rewritten-months")]
    incremental.append_batch(log.where("purchaseid >= 30"), str(tmp_path / "mart"), "2024-06-01")
    grown = incremental.incremental_mart(spark, str(tmp_path / "mart")).collect()
    whole = build_mart(log, "2024-06-01").collect()
    assert sorted(map(str, grown)) == sorted(map(str, whole))


def purchase_log(spark, n):
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int") * 3)
    return spark.range(0, n, 1, 2).select(
        F.when(F.col("id") % 7 != 0, F.col("id") % 5).alias("username"),
        F.col("id").alias("purchaseid"),
        F.when(F.col("id") % 11 != 0, day).alias("purchasedate"),
        F.date_add(day, 10).alias("expirationdate"),
        (F.col("id") % 9 + 1).cast("decimal(18,2)").alias("price"),
        F.lit(10).alias("duration"),
        F.lit(50).alias("bandwidth"),
        F.lit(0).alias("gig_product"),
        F.lit("a").alias("productname"),
        (F.col("id") % 3).alias("flowcount"),
        (F.col("id") % 4).alias("disruptioncount"),
    )


def test_good_rows_are_stored_without_their_text(spark, tmp_path):
    path = str(tmp_path / "cohort")
    rows = [(1, 10.0, 1.0, 0.5, 30), (2, -1.0, 1.0, 0.5, 30)]
    spark.createDataFrame(rows, "username long, catalog_price double, arpu double, arpu_trend double, duration int").write.option("header", True).csv(path)
    before = len(stored_names(spark))
    checked = read_checked_cohort(spark, path)
    (stored,) = session._paths.get(spark.sparkContext.applicationId, [])[before:]
    lines = [r[0] for r in spark.read.parquet(stored).select("_raw_line.line").collect()]
    assert sorted(line is None for line in lines) == [False, True]
    (bad,) = checked.bad.collect()
    assert bad.reason == "negative price" and "-1.0" in bad.line
    assert checked.good.count() == 1


def test_default_boosting_writes_no_checkpoints(spark):
    for classifier in Learner("boosted").classifiers(["arpu"]):
        assert classifier.getCheckpointInterval() > classifier.getMaxIter()


def test_large_mart_of_the_jobs_is_not_moved_by_month(spark, monkeypatch):
    log = purchase_log(spark, 40)
    by_month = {}
    for most in (0, 1000):
        monkeypatch.setattr(inputs, "_stored", {})
        monkeypatch.setattr(inputs, "MOST_ROWS_MOVED", most)
        monkeypatch.setattr(inputs, "purchases", lambda *_: log)
        mart = inputs.mart(spark, "any")
        by_month[most] = any("purchase_month=" in f for f in mart.inputFiles())
        assert sorted(map(str, mart.collect())) == sorted(map(str, build_mart(log, inputs.AS_OF, static_ip_pattern=inputs.STATIC_IP).collect()))
    assert by_month == {0: False, 1000: True}
