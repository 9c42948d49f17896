"""Purchase logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerwise.operators.lookup import hot_limit, skewed_lookup_join
from offerwise.schemas import MONEY, purchases_schema, require_columns
from offerwise.session import store


def read_purchases(spark: SparkSession, source: str, kind: str = "parquet") -> DataFrame:
    """A purchase log from files (`kind` names the format) or, with kind='table', a table.

    Columns are narrowed and cast to the contract; ids keep their own type.
    """
    raw = spark.read.table(source) if kind == "table" else spark.read.format(kind).load(source)
    contract = purchases_schema()
    require_columns(raw, contract.names, f"purchase log {source}")
    ids = {"username", "purchaseid"}
    return raw.select(
        *[F.col(f.name).alias(f.name) if f.name in ids else F.col(f.name).cast(f.dataType)
          for f in contract]
    )


# A part on more lines than this is kept out of the shuffle.
HOT_PART_LINES = 1_000_000


def _with_part_names(lineitem: DataFrame, part: DataFrame, hot_part_lines: int) -> DataFrame:
    names = part.where(F.col("p_partkey").isNotNull()).select(
        F.col("p_partkey").alias("l_partkey"), "p_name"
    )
    rows = lineitem.count()
    if rows > hot_part_lines:
        frequent = lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
        limit = hot_limit(hot_part_lines, rows)
        frequent = store(frequent.where(F.col("n") > limit).drop("n"), "hot-parts")
        if not frequent.isEmpty():
            # At most MOST_HOT_KEYS parts. Those without a name, NULL among them, are carried
            # too: their lines would otherwise gather in one task.
            found = names.join(F.broadcast(frequent), "l_partkey", "left_semi")
            hot = frequent.join(found, "l_partkey", "left")
            line = F.struct("l_orderkey", "l_linenumber")
            return skewed_lookup_join(lineitem, names, hot, ["l_partkey"], spread_by=line)
    return lineitem.join(names, "l_partkey", "left")


def purchases_from_orders(
    orders: DataFrame,
    lineitem: DataFrame,
    part: DataFrame,
    hot_part_lines: int = HOT_PART_LINES,
) -> DataFrame:
    """Read an order table as a purchase log: a customer's orders are the purchases.

    Line items are reduced to one row per order, map-side first, before they
    meet the orders; an order without lines stays.
    """
    lines = (
        _with_part_names(lineitem, part, hot_part_lines)
        .groupBy("l_orderkey")
        .agg(
            F.max("l_quantity").alias("top_quantity"),
            F.count(F.lit(1)).alias("line_count"),
            F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("returned"),
            F.count(F.when(F.col("l_linestatus") == "O", 1)).alias("open_lines"),
            F.min("p_name").alias("productname"),
        )
    )
    purchasedate = F.col("o_orderdate").cast("date")
    # Subscription length in days by order priority.
    duration = (
        F.when(F.col("o_orderpriority") == "1-URGENT", 30)
        .when(F.col("o_orderpriority") == "2-HIGH", 60)
        .when(F.col("o_orderpriority") == "3-MEDIUM", 90)
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", 180)
        .otherwise(365)
    )
    zero = F.lit(0)
    return orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left").select(
        F.col("o_custkey").alias("username"),
        F.col("o_orderkey").alias("purchaseid"),
        purchasedate.alias("purchasedate"),
        F.date_add(purchasedate, duration).alias("expirationdate"),
        F.col("o_totalprice").cast(MONEY).alias("price"),
        duration.alias("duration"),
        F.when(F.coalesce("top_quantity", zero) >= 40, 100).otherwise(50).alias("bandwidth"),
        F.when(F.coalesce("line_count", zero) >= 5, 1).otherwise(0).alias("gig_product"),
        "productname",
        F.coalesce("returned", zero).cast("bigint").alias("flowcount"),
        F.coalesce("open_lines", zero).cast("bigint").alias("disruptioncount"),
    )
