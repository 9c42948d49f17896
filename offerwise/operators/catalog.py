"""Catalog price: the highest price paid in a month for one product shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwise.functions import month_of
from offerwise.operators.lookup import hot_limit, lookup_left_join, skewed_lookup_join
from offerwise.session import store

SHAPE = ("catalog_month", "duration", "bandwidth", "gig_product", "has_static_ip")

# A cell takes well under 100 bytes, so a broadcast stays below 50 MB.
BROADCAST_CELLS = 500_000
HOT_CELL_ROWS = 1_000_000


def catalog_cells(purchases: DataFrame) -> DataFrame:
    """One row per product shape and month: its top price and its row count."""
    shaped = purchases.withColumn("catalog_month", month_of(F.col("purchasedate")))
    return shaped.groupBy(*SHAPE).agg(
        F.max("price").alias("catalog_price"), F.count(F.lit(1)).alias("cell_rows")
    )


def with_catalog_price(
    purchases: DataFrame,
    broadcast_cells: int = BROADCAST_CELLS,
    hot_cell_rows: int = HOT_CELL_ROWS,
) -> DataFrame:
    """Add `catalog_price` to every purchase.

    The cells are aggregated map-side first, so a cell holding most of the rows
    never gathers in one task. They are then joined back: by broadcast if their
    number is known to be small, else by a shuffle in which rows of hot cells
    take their price from the few hot cells and are spread over salts.
    """
    return priced_of(purchases, purchases.count(), broadcast_cells, hot_cell_rows)


def priced_of(
    purchases: DataFrame, rows: int, broadcast_cells: int, hot_cell_rows: int
) -> DataFrame:
    """`with_catalog_price` where `rows`, the row count of `purchases` and an upper bound of
    the cell count, has just been taken."""
    return join_cells(purchases, catalog_cells(purchases), rows, broadcast_cells, hot_cell_rows)


def join_cells(
    purchases: DataFrame, cells: DataFrame, rows: int, broadcast_cells: int, hot_cell_rows: int
) -> DataFrame:
    """`purchases` with the price of their cell, if it is among `cells`. `rows` is an upper bound
    of the number of cells and of their rows."""
    shaped = purchases.withColumn("catalog_month", month_of(F.col("purchasedate")))
    if rows > broadcast_cells:
        cells = store(cells, "catalog-cells")
        if cells.count() > broadcast_cells:
            # At most MOST_HOT_KEYS cells are hot, whatever the size of the input.
            hot = cells.where(F.col("cell_rows") > hot_limit(hot_cell_rows, rows)).drop("cell_rows")
            joined = skewed_lookup_join(
                shaped, cells.drop("cell_rows"), hot, SHAPE, spread_by=F.col("purchaseid")
            )
            return joined.drop("catalog_month")
    joined = lookup_left_join(shaped, F.broadcast(cells.drop("cell_rows")), SHAPE)
    return joined.drop("catalog_month")
