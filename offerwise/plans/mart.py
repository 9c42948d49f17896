"""The feature mart: one labelled, feature-rich row per purchase."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwise.functions import flag_like, safe_ratio
from offerwise.operators.catalog import BROADCAST_CELLS, HOT_CELL_ROWS, priced_of
from offerwise.operators.history import CHUNK_ROWS, HOT_USER_ROWS, history_of
from offerwise.operators.labels import GRACE_DAYS, customer_action
from offerwise.schemas import LABEL, mart_schema, purchases_schema, require_columns

# Fixed value: product names that include a static address.
STATIC_IP_PATTERN = "%Static IP%"

SKEW_LIMITS = {
    "hot_user_rows": HOT_USER_ROWS,
    "chunk_rows": CHUNK_ROWS,
    "broadcast_cells": BROADCAST_CELLS,
    "hot_cell_rows": HOT_CELL_ROWS,
}


def stage_purchases(purchases: DataFrame, static_ip_pattern: str = STATIC_IP_PATTERN) -> DataFrame:
    """Purchase log with its derived flags, under the names the mart uses."""
    require_columns(purchases, purchases_schema().names, "purchase log")
    return purchases.withColumnRenamed("flowcount", "supportcallcount").withColumn(
        "has_static_ip", flag_like(F.col("productname"), static_ip_pattern)
    )


def with_arpu(df: DataFrame) -> DataFrame:
    """Revenue per day of this and of the previous purchase (0 before the first)."""
    return df.withColumns(
        {
            "arpu": safe_ratio(F.col("price"), F.col("duration")),
            "prev_arpu": safe_ratio(F.col("prev_price"), F.col("prev_duration")),
        }
    )


def with_hidden_discount(df: DataFrame) -> DataFrame:
    """How far the paid price lies below the catalog price, as amount and share."""
    amount = F.col("catalog_price") - F.col("price")
    return df.withColumns(
        {
            "hidden_discount_amount": amount.cast("double"),
            "hidden_discount_percentage": safe_ratio(amount, F.col("catalog_price")),
        }
    )


def with_trends(df: DataFrame) -> DataFrame:
    """Change against the previous purchase; only `arpu_trend` has a value on the first."""
    return df.withColumns(
        {
            "gap_days": F.datediff("purchasedate", "prev_expirationdate"),
            "arpu_trend": F.col("arpu") - F.col("prev_arpu"),
            "supportcallcount_trend": F.col("supportcallcount")
            - F.col("prev_supportcallcount"),
        }
    )


def build_mart(
    purchases: DataFrame,
    as_of: dt.date | str,
    grace_days: int = GRACE_DAYS,
    static_ip_pattern: str = STATIC_IP_PATTERN,
    **skew_limits: int,
) -> DataFrame:
    """Purchase log -> mart, one row per purchase.

    The plan is one partially aggregated exchange for the catalog cells, a
    broadcast join, and one exchange on the customer for all windows. Pass a
    materialised log: rows, cells and large customers are counted on it first.
    `skew_limits` may set the values of SKEW_LIMITS.
    """
    limits = SKEW_LIMITS | skew_limits
    if unknown := skew_limits.keys() - SKEW_LIMITS.keys():
        raise TypeError(f"unknown limit(s): {', '.join(sorted(unknown))}")
    rows = purchases.count()
    staged = stage_purchases(purchases, static_ip_pattern)
    priced = priced_of(staged, rows, limits["broadcast_cells"], limits["hot_cell_rows"])
    enriched = history_of(priced, rows, limits["hot_user_rows"], limits["chunk_rows"])
    return mart_rows(enriched, as_of, grace_days)


def mart_rows(enriched: DataFrame, as_of: dt.date | str, grace_days: int = GRACE_DAYS) -> DataFrame:
    """The mart's columns of priced purchases with their history."""
    enriched = with_trends(with_hidden_discount(with_arpu(enriched))).withColumn(
        LABEL, customer_action(as_of, grace_days)
    )
    key = enriched.schema["username"].dataType
    id_type = enriched.schema["purchaseid"].dataType
    kinds = {f.name: f.dataType for f in mart_schema(key)} | {"purchaseid": id_type}
    return enriched.select(*[F.col(c).cast(t) for c, t in kinds.items()])
