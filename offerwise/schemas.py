"""Column contracts shared by every job in the package."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names and roles that readers of the mart rely on.
LABEL = "customer_action"
OUTCOMES = (0, 1, 2)  # accept, downgrade, churn
FEATURES = (
    "catalog_price",
    "hidden_discount_amount",
    "hidden_discount_percentage",
    "duration",
    "bandwidth",
    "gig_product",
    "has_static_ip",
    "purchase_sequence",
    "arpu",
    "cumulative_ltv",
    "gap_days",
    "arpu_trend",
    "supportcallcount_trend",
    "rolling_3_disruptioncount",
)
NON_FEATURES = (
    "username",
    "purchaseid",
    "purchasedate",
    "province",
    "salesagent",
    "actual_paid_price",
)
PRICE_FEATURES = ("arpu", "arpu_trend", "catalog_price")
LATENT_FEATURES = ("hidden_discount_percentage", "catalog_price", "hidden_discount_amount")
PROBABILITIES = ("p_accept", "p_downgrade", "p_churn")

# Features that are NULL on a customer's first purchase. Models read them as 0
# next to a 0/1 "<name>_missing" column.
MISSABLE = ("gap_days", "supportcallcount_trend", "rolling_3_disruptioncount")

MONEY = T.DecimalType(18, 2)

# What a cohort file must have, and what a feature file may have besides.
COHORT_COLUMNS = ("username", "catalog_price", "arpu", "arpu_trend", "duration")
OPTIONAL_COLUMNS = (
    T.StructField("province", T.StringType()),
    T.StructField("salesagent", T.StringType()),
    T.StructField("actual_paid_price", MONEY),
)


def purchases_schema(key: T.DataType = T.StringType()) -> T.StructType:
    """Purchase log: one row per purchase, `key` being the type of both ids."""
    return (
        T.StructType()
        .add("username", key)
        .add("purchaseid", key)
        .add("purchasedate", T.DateType())
        .add("expirationdate", T.DateType())
        .add("price", MONEY)
        .add("duration", T.IntegerType())
        .add("bandwidth", T.IntegerType())
        .add("gig_product", T.IntegerType())
        .add("productname", T.StringType())
        .add("flowcount", T.LongType())
        .add("disruptioncount", T.LongType())
    )


def mart_schema(key: T.DataType = T.StringType()) -> T.StructType:
    """The 18 columns of the feature mart, in order."""
    return (
        T.StructType()
        .add("username", key)
        .add("purchaseid", key)
        .add("purchasedate", T.DateType())
        .add("catalog_price", T.DoubleType())
        .add("hidden_discount_amount", T.DoubleType())
        .add("hidden_discount_percentage", T.DoubleType())
        .add("duration", T.IntegerType())
        .add("bandwidth", T.IntegerType())
        .add("gig_product", T.IntegerType())
        .add("has_static_ip", T.IntegerType())
        .add("purchase_sequence", T.LongType())
        .add(LABEL, T.IntegerType())
        .add("arpu", T.DoubleType())
        .add("cumulative_ltv", T.DoubleType())
        .add("gap_days", T.IntegerType())
        .add("arpu_trend", T.DoubleType())
        .add("supportcallcount_trend", T.LongType())
        .add("rolling_3_disruptioncount", T.DoubleType())
    )


def cohort_schema(key: T.DataType = T.StringType()) -> T.StructType:
    """At-risk customers to price. Any further mart feature is optional."""
    return (
        T.StructType()
        .add("username", key)
        .add("catalog_price", T.DoubleType())
        .add("arpu", T.DoubleType())
        .add("arpu_trend", T.DoubleType())
        .add("duration", T.IntegerType())
        .add("rolling_3_disruptioncount", T.DoubleType())
    )


def require_columns(df: DataFrame, names: Iterable[str], what: str = "input") -> DataFrame:
    """Return `df`, or raise before any job runs if columns are missing."""
    present = {c.lower() for c in df.columns}
    missing = [n for n in names if n.lower() not in present]
    if missing:
        raise ValueError(f"{what} lacks required column(s): {', '.join(missing)}")
    return df


def feature_columns(df: DataFrame) -> list[str]:
    """Model inputs of `df`: every column that is neither an id nor the label."""
    skipped = {*NON_FEATURES, LABEL}
    return [c for c in df.columns if c.lower() not in skipped]
