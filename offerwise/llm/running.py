"""Running totals in a global order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from offerwise.llm.tables import store


def running_total(df: DataFrame, order: Sequence[Column], value: str, out: str, name: str) -> DataFrame:
    """`df` with `out`: the sum of `value` over all rows before each one in `order`.

    Rows are range-partitioned and stored with their partition's number, so that a retry
    cannot move them. Totals of partitions (one small row each) are summed in order; within
    a partition a window does the rest. `order` must tell rows apart that differ in `value`.
    """
    ranged = store(
        df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name
    )
    sums = ranged.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = F.sum("_sum").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = sums.select("_part", F.coalesce(before, F.lit(0)).alias("_offset"))
    inside = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_offset") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_part", "_offset")
    )
