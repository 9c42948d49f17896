"""Mart tables, cohorts, campaign lists and external churn files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerwise.functions import month_of
from offerwise.schemas import (
    COHORT_COLUMNS,
    OPTIONAL_COLUMNS,
    cohort_schema,
    mart_schema,
    require_columns,
)
from offerwise.session import store


def write_mart(mart: DataFrame, path: str) -> None:
    """Materialise the mart as Parquet, one folder per purchase month.

    The rebalance hint lets Spark split large months and merge small ones, so
    the number of files follows the data, not tasks times months.
    """
    dated = mart.withColumn("purchase_month", month_of(F.col("purchasedate")))
    (
        dated.hint("rebalance", "purchase_month")
        .write.mode("overwrite")
        .partitionBy("purchase_month")
        .parquet(path)
    )


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """A materialised mart; filters on purchase_month prune folders."""
    return spark.read.parquet(path)


def save_by_customer(
    df: DataFrame, name: str, buckets: int, path: str | None = None, key: str = "username"
) -> DataFrame:
    """Save a purchase log or a mart as catalogue table `name`, bucketed by customer, and read it.

    Windows, aggregates and joins by customer then need no exchange, however often they are
    run. Rows are dealt out as the buckets are, so that each bucket is one file. Choose
    `buckets` so that one fits a task: as many as the job would have shuffle partitions. `path`
    puts the files outside the warehouse.
    """
    order = [c for c in ("purchasedate", "purchaseid") if c in df.columns]
    writer = (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key, *order)
    )
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.read.table(name)


def write_features_csv(mart: DataFrame, path: str) -> None:
    mart.write.mode("overwrite").option("header", True).csv(path)


def read_features_csv(
    spark: SparkSession, path: str, key: T.DataType = T.StringType()
) -> DataFrame:
    """A mart exported as CSV, with the mart's types instead of inferred ones.

    Columns may stand in any order. Optional ones get their type, others stay text.
    """
    df = _read_csv(spark, path, [*mart_schema(key), *OPTIONAL_COLUMNS])
    return require_columns(df, mart_schema().names, path)


def read_cohort_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """At-risk customers to price. Fails on values that do not fit their column's type.

    Five columns are required (COHORT_COLUMNS); any further mart feature is taken along,
    in any order. Features the file lacks count as 0.0 when a model is applied.
    """
    known = [*(schema or []), *cohort_schema(), *mart_schema(), *OPTIONAL_COLUMNS]
    return require_columns(_read_csv(spark, path, known), COHORT_COLUMNS, path)


def with_row_id(df: DataFrame, name: str = "purchaseid") -> DataFrame:
    """Number the rows of a table that has no key, for jobs that need one.

    The numbers are unique, not consecutive. They are stored with the rows, so that they
    stay the same however often the result is read.
    """
    return store(df.withColumn(name, F.monotonically_increasing_id()), "numbered-rows")


def write_target_list(targets: DataFrame, path: str) -> None:
    """The campaign list as CSV files, written by the executors."""
    targets.write.mode("overwrite").option("header", True).csv(path)


def read_churn_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An external churn dataset that was landed as CSV."""
    df = _read_csv(spark, path, schema)
    return require_columns(
        df, ["customerID", "TotalCharges", "MonthlyCharges", "Contract", "Churn"], path
    )


def csv_schema(spark: SparkSession, path: str, known: Iterable[T.StructField]) -> T.StructType:
    """Columns in the order of the header; the first of `known` fields with a name types it."""
    header = spark.read.option("header", True).csv(path).columns
    types: dict[str, T.DataType] = {}
    for field in known:
        types.setdefault(field.name.lower(), field.dataType)
    return T.StructType([T.StructField(c, types.get(c.lower(), T.StringType())) for c in header])


def _read_csv(spark: SparkSession, path: str, known: Iterable[T.StructField]) -> DataFrame:
    return (
        spark.read.schema(csv_schema(spark, path, known))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
