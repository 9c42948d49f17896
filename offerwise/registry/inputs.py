"""The test tables as purchase log, mart and cohort.

Like a warehouse would, a session stages the purchase log and materialises the
mart once; the jobs downstream read these tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerwise.operators.scoring import SoftmaxScorer
from offerwise.plans.mart import build_mart, stage_purchases
from offerwise.plans.training import TrainingRun, labelled, train
from offerwise.session import scratch_path, store
from offerwise.sources.purchases import purchases_from_orders
from offerwise.sources.tables import read_mart, write_mart

AS_OF = "2001-08-01"  # the latest order date of every test scale
PURCHASE_TABLES = ("orders", "lineitem", "part")
MOST_ROWS_MOVED = 500_000
STATIC_IP = "%ring%"  # stands in for the product-name pattern

# Known coefficients, so that scored results can be computed in SQL as well.
SCORER = SoftmaxScorer(
    features=("arpu", "arpu_trend"),
    coefficients=((0.0, 0.0), (0.0002, 0.0), (0.0005, 0.0001)),
    intercepts=(0.0, -0.3, 0.0),
)

_stored: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        _stored[key] = make()
    return _stored[key]


def raw_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchases_from_orders(*[table(spark, sf_dir, n) for n in PURCHASE_TABLES])


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark, sf_dir, "purchases", lambda: store(raw_purchases(spark, sf_dir), "purchases")
    )


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_purchases(purchases(spark, sf_dir), STATIC_IP)


def built_mart(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    return build_mart(
        purchases(spark, sf_dir), AS_OF, static_ip_pattern=STATIC_IP, **limits
    )


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart, by month if it is small. The rows of a large one stay with the tasks that made
    them, in order of time: no job here reads single months, and moving them costs a shuffle."""

    def make() -> DataFrame:
        built = built_mart(spark, sf_dir)
        if purchases(spark, sf_dir).count() > MOST_ROWS_MOVED:
            return store(built.sortWithinPartitions("purchasedate"), "mart")
        path = scratch_path(spark, "mart")
        write_mart(built, path)
        return read_mart(spark, path).drop("purchase_month")

    return _once(spark, sf_dir, "mart", make)


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(mart(spark, sf_dir))


def churn_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in the shape of an external churn dataset."""
    charge = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customerID"),
        F.when(F.col("c_custkey") % 10 == 0, " ").otherwise(charge.cast("string")).alias(
            "TotalCharges"
        ),
        F.when(F.col("c_custkey") % 17 != 0, charge).alias("MonthlyCharges"),
        F.when(F.col("c_custkey") % 3 == 0, "Month-to-month").otherwise("One year").alias(
            "Contract"
        ),
        F.col("c_mktsegment").alias("Segment"),
        F.when(charge < 2500, "Yes").otherwise("No").alias("Churn"),
    )


def training_run(spark: SparkSession, sf_dir: str) -> TrainingRun:
    """A full training run: the default search, calibration and report."""
    return _once(spark, sf_dir, "training-run", lambda: train(mart(spark, sf_dir)))
