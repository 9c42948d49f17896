"""What came before and after each purchase of the same customer."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerwise.operators.lookup import hot_limit
from offerwise.session import store

ORDER = ("purchasedate", "purchaseid")
NEXT = ("purchasedate", "price", "duration")
PREV = ("expirationdate", "price", "duration", "supportcallcount")

# A history of this many rows still sorts in one task.
HOT_USER_ROWS = 1_000_000
CHUNK_ROWS = 1_000_000
BROADCAST_CHUNKS = 100_000


def with_history(
    purchases: DataFrame,
    hot_user_rows: int = HOT_USER_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add sequence number, earlier spend, neighbours and recent disruptions.

    All of it comes from one window over the customer's purchases, so from one
    exchange and one sort. Customers with more than `hot_user_rows` purchases
    (and a share of all rows, see `hot_limit`) are split into ordered chunks
    instead, see `_split_history`.
    """
    return history_of(purchases, purchases.count(), hot_user_rows, chunk_rows)


def history_of(purchases: DataFrame, rows: int, hot_user_rows: int, chunk_rows: int) -> DataFrame:
    """`with_history` where `rows`, the row count of `purchases`, has just been taken."""
    return finished(windows_of(purchases, rows, hot_user_rows, chunk_rows))


def windows_of(purchases: DataFrame, rows: int, hot_user_rows: int, chunk_rows: int) -> DataFrame:
    """What `finished` makes the history of, and `carried` may put earlier purchases before."""
    if rows <= hot_user_rows:
        return _windows(purchases, "username")
    hot = _hot_users(purchases, hot_limit(hot_user_rows, rows))
    users, hot_rows = hot.agg(F.count("user_rows"), F.sum("user_rows")).first()
    if not users:
        return _windows(purchases, "username")
    # At most MOST_HOT_KEYS customers are hot, whatever the size of the input.
    match = purchases["username"].eqNullSafe(hot["hot_name"])
    usual = purchases.join(F.broadcast(hot), match, "left_anti")
    crowded = purchases.join(F.broadcast(hot), match, "inner").drop("hot_name", "user_rows")
    split = _split_history(crowded, users, math.ceil(hot_rows / chunk_rows))
    return _windows(usual, "username").unionByName(split.drop("hot_id", "chunk"))


def _hot_users(purchases: DataFrame, hot_user_rows: int) -> DataFrame:
    counts = purchases.groupBy(F.col("username").alias("hot_name")).agg(
        F.count(F.lit(1)).alias("user_rows")
    )
    hot = counts.where(F.col("user_rows") > hot_user_rows)
    return store(hot.withColumn("hot_id", F.monotonically_increasing_id()), "hot-users")


def _windows(df: DataFrame, *group: str) -> DataFrame:
    ordered = Window.partitionBy(*group).orderBy(*[F.asc_nulls_first(c) for c in ORDER])
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    recent = ordered.rowsBetween(-3, -1)
    return df.withColumns(
        {
            "purchase_sequence": F.row_number().over(ordered).cast("bigint"),
            "spent_before": F.coalesce(
                F.sum("price").over(earlier), F.lit(0).cast("decimal(28,2)")
            ),
            # Structs tell "no such row" from "a row with NULLs".
            "next_row": F.lead(F.struct(*NEXT)).over(ordered),
            "prev_row": F.lag(F.struct(*PREV)).over(ordered),
            "recent_sum": F.coalesce(F.sum("disruptioncount").over(recent), F.lit(0)),
            "recent_count": F.count("disruptioncount").over(recent),
        }
    )


def finished(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "cumulative_ltv": F.col("spent_before").cast("decimal(28,2)"),
            **{f"next_{c}": F.col(f"next_row.{c}") for c in NEXT},
            **{f"prev_{c}": F.col(f"prev_row.{c}") for c in PREV},
            "rolling_3_disruptioncount": F.when(
                F.col("recent_count") > 0, F.col("recent_sum") / F.col("recent_count")
            ),
        }
    ).drop("spent_before", "next_row", "prev_row", "recent_sum", "recent_count")


def _split_history(crowded: DataFrame, users: int, chunks: int) -> DataFrame:
    """The same columns as `_windows` for customers too large for one task.

    A range partitioning on customer and purchase order cuts the rows into even
    chunks, whatever the customer or the date they share. The chunk number is
    stored, since it must not change between the two reads below. Windows run
    inside (customer, chunk); a row per chunk then carries over what lies
    before and after it.
    """
    placed = store(
        crowded.repartitionByRange(
            chunks, "hot_id", *[F.asc_nulls_first(c) for c in ORDER]
        ).withColumn("chunk", F.spark_partition_id()),
        "history-chunks",
    )
    around = _chunk_surroundings(placed)
    # A chunk boundary or a change of customer starts a row of `around`.
    if chunks + users <= BROADCAST_CHUNKS:
        around = F.broadcast(around)
    return carried(_windows(placed, "hot_id", "chunk").join(around, ["hot_id", "chunk"]))


def carried(local: DataFrame) -> DataFrame:
    """Windows over part of a customer's purchases, put between those before and after it.

    Every row has, of the part it lies in: rows_earlier, spent_earlier, row_before and
    earlier_disruptions (the latest three, latest first) of what comes before, and row_after.
    """
    position = F.col("purchase_sequence")
    carried_sum, carried_count = F.col("recent_sum"), F.col("recent_count")
    for back in (1, 2, 3):
        # The row `back` places before the chunk is in reach of its first rows only.
        value = F.when(position <= 4 - back, F.get("earlier_disruptions", F.lit(back - 1)))
        carried_sum = carried_sum + F.coalesce(value, F.lit(0))
        carried_count = carried_count + F.when(value.isNotNull(), 1).otherwise(0)
    return local.withColumns(
        {
            "purchase_sequence": position + F.col("rows_earlier"),
            "spent_before": (F.col("spent_before") + F.col("spent_earlier")).cast("decimal(28,2)"),
            "next_row": F.coalesce("next_row", "row_after"),
            "prev_row": F.coalesce("prev_row", "row_before"),
            "recent_sum": carried_sum,
            "recent_count": carried_count,
        }
    ).drop("rows_earlier", "spent_earlier", "row_after", "row_before", "earlier_disruptions")


def _chunk_surroundings(placed: DataFrame) -> DataFrame:
    """Per (customer, chunk): totals before it and the rows next to it."""
    key = ["hot_id", "chunk"]
    totals = placed.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("price").alias("spent"),
        F.min(F.struct(*ORDER, F.struct(*NEXT).alias("row"))).alias("first"),
        F.max(F.struct(*ORDER, F.struct(*PREV).alias("row"))).alias("last"),
    )
    latest_first = Window.partitionBy(*key).orderBy(*[F.desc_nulls_last(c) for c in ORDER])
    tails = (
        placed.select(*key, *ORDER, "disruptioncount")
        .withColumn("back", F.row_number().over(latest_first))
        .where(F.col("back") <= 3)
        .groupBy(*key)
        .agg(F.sort_array(F.collect_list(F.struct("back", "disruptioncount"))).alias("tail"))
        .withColumn("tail", F.col("tail.disruptioncount"))
    )
    by_chunk = Window.partitionBy("hot_id").orderBy("chunk")
    before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    none = F.array().cast("array<bigint>")
    # A chunk may hold a single row, so the three latest rows span up to three chunks.
    tails_before = [F.coalesce(F.lag("tail", k).over(by_chunk), none) for k in (1, 2, 3)]
    return totals.join(tails, key).select(
        *key,
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_earlier"),
        F.coalesce(F.sum("spent").over(before), F.lit(0)).alias("spent_earlier"),
        F.lead("first.row").over(by_chunk).alias("row_after"),
        F.lag("last.row").over(by_chunk).alias("row_before"),
        F.slice(F.concat(*tails_before), 1, 3).alias("earlier_disruptions"),
    )
