"""Samples and splits that depend on row keys, not on how the data is laid out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerwise.functions import hash_bucket, keyed_digest

BUCKETS = 10_000
FINE_BUCKETS = 1 << 20
DIRECT_SAMPLE_ROWS = 1_000_000


def split(
    df: DataFrame,
    key: str = "purchaseid",
    train_share: float = 0.7,
    bucket: Callable[[Column], Column] = hash_bucket,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the key: a filter each, no shuffle.

    Equal keys share a side, and so do all labels derived from a row.
    """
    limit = round(train_share * BUCKETS)
    place = bucket(F.col(key))
    return df.where(place < limit), df.where(place >= limit)


def fine_bucket(key: Column) -> Column:
    return hash_bucket(key, buckets=FINE_BUCKETS)


def stratified_split(
    df: DataFrame,
    label: str,
    key: str = "purchaseid",
    train_share: float = 0.8,
    bucket: Callable[[Column], Column] = fine_bucket,
) -> DataFrame:
    """Add `in_train`, true for exactly round(train_share * n) rows of every class.

    Rows are taken in order of (bucket, key). A histogram of the buckets tells
    in which one a class fills up; only that bucket's rows are ranked, about a
    millionth of a class, so no class is ever sorted as a whole. The last row
    taken of each class then decides for all rows in one filter. `key` must be
    unique.
    """
    placed = df.withColumn("_bucket", bucket(F.col(key)))
    sizes = placed.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("n"))
    in_class = Window.partitionBy(label)
    below = in_class.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        sizes.withColumns(
            {
                "wanted": F.round(F.sum("n").over(in_class) * train_share).cast("bigint"),
                "taken": F.coalesce(F.sum("n").over(below), F.lit(0)),
            }
        )
        .where((F.col("taken") < F.col("wanted")) & (F.col("taken") + F.col("n") >= F.col("wanted")))
        .select(
            F.col(label).alias("_class"),
            F.col("_bucket").alias("cut"),
            (F.col("wanted") - F.col("taken")).alias("left_over"),
        )
    )
    # One row per class, here and below.
    same_class = placed[label].eqNullSafe(cuts["_class"])
    near = placed.join(F.broadcast(cuts), same_class & (F.col("_bucket") == F.col("cut")))
    in_order = Window.partitionBy("_class").orderBy(F.asc_nulls_first(key))
    last = (
        near.withColumn("_rank", F.row_number().over(in_order))
        .where(F.col("_rank") == F.col("left_over"))
        .select("_class", F.struct("_bucket", F.col(key)).alias("_last"))
    )
    joined = placed.join(F.broadcast(last), placed[label].eqNullSafe(last["_class"]), "left")
    taken = F.coalesce(F.struct("_bucket", F.col(key)) <= F.col("_last"), F.lit(False))
    return joined.withColumn("in_train", taken).drop("_bucket", "_class", "_last")


def sample_rows(df: DataFrame, n: int, key: str = "purchaseid", seed: int = 42) -> DataFrame:
    """At most `n` rows, those with the smallest digest of the key; all rows if there are fewer.

    On a large input a threshold on the digest first leaves a few times `n`
    rows, so that tasks do not each keep `n`. If it left too few, all rows
    compete.
    """
    draw = keyed_digest(F.col(key), seed)
    rows = df.count()
    if rows > max(DIRECT_SAMPLE_ROWS, 8 * n):
        share = min(1.0, (4 * n + 1000) / rows)
        near = df.where(draw < F.lit(f"{int(share * (16**12 - 1)):012x}"))
        if near.count() >= n:
            df = near
    return df.orderBy(draw, F.asc_nulls_first(key)).limit(n)
