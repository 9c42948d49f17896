"""CSV files of which some rows are bad: good rows to one table, bad ones to another."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerwise.schemas import COHORT_COLUMNS, OPTIONAL_COLUMNS, cohort_schema, mart_schema, require_columns
from offerwise.session import store
from offerwise.sources.tables import csv_schema

RAW = "_raw_line"


@dataclass(frozen=True)
class Checked:
    """Good rows with their types; bad rows as (file, line, reason)."""

    good: DataFrame
    bad: DataFrame

    def write(self, good: str, bad: str) -> None:
        self.good.write.mode("overwrite").parquet(good)
        self.bad.write.mode("overwrite").parquet(bad)


def read_checked_csv(
    spark: SparkSession,
    path: str,
    known: Iterable[T.StructField],
    required: Iterable[str],
    rules: Mapping[str, Column] | None = None,
) -> Checked:
    """Read CSV by its header and keep apart what does not fit.

    A row is bad if a value is not of its column's type or its number of values is not the
    header's ('malformed'), if a required value is missing ('no <column>'), or if a rule, a
    condition on the columns, is not true of it (the rule's name); the first reason counts.
    A missing column fails at once. Rows are parsed once and stored, so that no row is in both
    tables or in none.
    """
    required = list(required)
    schema = csv_schema(spark, path, known)
    reader = (
        spark.read.schema(T.StructType([*schema, T.StructField(RAW, T.StringType())]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RAW)
    )
    rows = require_columns(reader.csv(path), required, path)
    reason = F.when(F.col(RAW).isNotNull(), F.lit("malformed"))
    for name in required:
        reason = reason.when(F.col(f"`{name}`").isNull(), F.lit(f"no {name}"))
    for name, rule in (rules or {}).items():
        reason = reason.when(~F.coalesce(rule, F.lit(False)), F.lit(name))
    # A line that parsed is given as JSON: the reader keeps raw text of malformed ones only.
    line = F.coalesce(RAW, F.to_json(F.struct(*[f"`{c}`" for c in schema.names])))
    told = rows.select(
        *[f"`{c}`" for c in schema.names],
        F.struct(
            F.col("_metadata.file_name").alias("file"),
            F.when(reason.isNotNull(), line).alias("line"),  # good rows need no text of themselves
            reason.alias("reason"),
        ).alias(RAW),
    )
    stored = store(told, "checked-rows")
    return Checked(
        stored.where(F.col(f"{RAW}.reason").isNull()).drop(RAW),
        stored.where(F.col(f"{RAW}.reason").isNotNull()).select(f"{RAW}.*"),
    )


def read_checked_cohort(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> Checked:
    """`read_cohort_csv` that goes on where that one fails: bad rows are kept apart.

    Customers to price need all five required values, and a price that is not negative.
    """
    known = [*(schema or []), *cohort_schema(), *mart_schema(), *OPTIONAL_COLUMNS]
    rules = {"negative price": F.col("catalog_price") >= 0}
    return read_checked_csv(spark, path, known, COHORT_COLUMNS, rules)
