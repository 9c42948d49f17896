"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwise.llm.tables import store


def _directed(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller node, once each."""
    return (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where(F.col("a") != F.col("b"))
        .distinct()
    )


def _star(edges: DataFrame, all_neighbours: bool) -> DataFrame:
    """Link the (larger, or smaller) neighbours of each node to the least node around it."""
    if all_neighbours:
        seen = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        seen = edges
    # A minimum is combined before the shuffle; large stars are split by the skew join.
    least = seen.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = seen.join(least, "a")
    if all_neighbours:
        made = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        made = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return _directed(made)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge (a, b); root is the component's least node.

    Rounds grow with the logarithm of the longest path. Each round is stored, so a lost
    executor costs a re-read. An empty edge table gives an empty result.
    """
    current, before = store(_directed(edges), "edges"), None
    while True:
        state = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before or not state[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state
        current = store(_star(_star(current, True), False), "edges")
