"""Stored intermediate tables and joins that bear frequent keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerwise.operators.lookup import skewed_lookup_join
from offerwise.session import scratch_path, store

HOT_SHARE = 5_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def attach(rows: DataFrame, table: DataFrame, keys: Sequence[str], count: str, spread_by: Column) -> DataFrame:
    """Left join of `rows` to `table`, which has one row per key and the key's `count` of rows.

    Keys with over a HOT_SHARE-th of all rows (and over 1000) are joined by broadcast:
    there are at most HOT_SHARE of them. No task of the shuffle gets more rows of one key.
    """
    total = table.agg(F.sum(count)).first()[0] or 0
    hot = table.where(F.col(count) > max(1000, total // HOT_SHARE))
    return skewed_lookup_join(rows, table, hot, keys, spread_by)


def unused(df: DataFrame, stem: str) -> str:
    """A column name that `df` does not have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType) or (isinstance(kind, T.ArrayType) and _has_map(kind.elementType))


def row_hash(docs: DataFrame, *salt: Column) -> Column:
    """Tells rows apart by all their columns; rows that agree in all are interchangeable."""
    # Maps have no hash; as text they do.
    cells = [
        F.to_json(F.struct(F.col(f"`{f.name}`"))) if _has_map(f.dataType) else F.col(f"`{f.name}`")
        for f in docs.schema
    ]
    return F.xxhash64(*salt, *cells)


def one_each(docs: DataFrame, keepers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of `docs` for every distinct `keys` in `keepers`; NULL keys match each other."""
    names = [unused(docs, f"_{k}") for k in keys]
    wanted = keepers.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).distinct()
    match = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)]
    copies = W.partitionBy(*keys).orderBy(row_hash(docs))
    copy = unused(docs, "_copy")
    return (
        docs.join(wanted, match, "left_semi")
        .withColumn(copy, F.row_number().over(copies))
        .where(F.col(copy) == 1)
        .drop(copy)
    )


def store_dense(df: DataFrame, name: str) -> DataFrame:
    """`store` with stronger compression, for texts that overlap."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


__all__ = ["attach", "documents", "one_each", "row_hash", "store", "store_dense", "unused"]
