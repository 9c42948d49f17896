"""Left joins to a table with one row per key, when some keys hold very many rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Salts replicate nothing, so there can be as many as it takes.
SALTS = 1 << 31

# Rows of frequent keys are broadcast; this many keys stay well below 50 MB.
MOST_HOT_KEYS = 200_000


def hot_limit(limit: int, rows: int) -> int:
    """How many rows make a key hot: over `limit`, and so many that at most MOST_HOT_KEYS
    keys of `rows` rows can be hot."""
    return max(limit, rows // MOST_HOT_KEYS)


def lookup_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join in which NULL keys match each other, keeping the left key columns."""
    renamed = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    match = [left[k].eqNullSafe(renamed[f"_{k}"]) for k in keys]
    return left.join(renamed, match, "left").drop(*[f"_{k}" for k in keys])


def skewed_lookup_join(
    left: DataFrame,
    right: DataFrame,
    hot: DataFrame,
    keys: Sequence[str],
    spread_by: Column,
) -> DataFrame:
    """`lookup_left_join` by shuffle in which no hot key gathers in one task.

    `hot` holds the rows of `right` whose keys are frequent on the left. It is
    broadcast, so its size must be bounded. Left rows that find their key there
    are done; in the shuffle they are spread over salts, by a hash of
    `spread_by`, where nothing matches them.
    """
    values = [c for c in right.columns if c not in keys]
    packed = hot.select(*keys, F.struct(*values).alias("_hot"))
    marked = lookup_left_join(left, F.broadcast(packed), keys).withColumn(
        "_salt",
        F.when(F.col("_hot").isNull(), 0).otherwise(
            1 + F.pmod(F.xxhash64(spread_by), F.lit(SALTS))
        ),
    )
    unsalted = right.withColumn("_salt", F.lit(0).cast("bigint"))
    joined = lookup_left_join(marked, unsalted, [*keys, "_salt"])
    found = {
        v: F.when(F.col("_hot").isNull(), F.col(v)).otherwise(F.col(f"_hot.{v}")) for v in values
    }
    return joined.withColumns(found).drop("_hot", "_salt")
