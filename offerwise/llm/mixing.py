"""Mixing sources to target weights by weighted fair queueing.

Every source's documents are shuffled (ordered by a hash of their key) and queued, the
whole queue twice. A document's virtual finish time is the words of its source's queue up
to and with it, divided by the source's target. The queue of all sources is range-sorted by
finish time and cut where the total budget is used up. Each source is then served in
proportion to its target, to within one document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from offerwise.llm.running import running_total
from offerwise.llm.tables import attach, row_hash, store, unused
from offerwise.operators.lookup import lookup_left_join

WEIGHTS = (5, 2, 1)
SHARE = 1.5
COPIES = 2
# So many sources are broadcast and ranked in one task; more are joined and ranked by shuffle.
FEW_SOURCES = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: str = "text") -> Column:
    """Words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def _after(df: DataFrame, order: Sequence[Column], values: dict[str, str], few: bool) -> DataFrame:
    """`df` with, for each new name, the sum of a column over the rows before each one in `order`."""
    if few:  # one task holds the sources
        earlier = W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
        zero = {v: F.lit(0).cast(df.schema[v].dataType) for v in values.values()}
        return df.withColumns(
            {n: F.coalesce(F.sum(v).over(earlier), zero[v]) for n, v in values.items()}
        )
    for name, value in values.items():
        df = running_total(df, order, value, name, "mix-sources")
    return df


def targets(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    copies: int = COPIES,
    few: bool = True,
) -> DataFrame:
    """`sizes` (source, source_size; one row a source) with `rank`, `target` and the words of the
    sources before (`_first`).

    Sources by code point, NULL last, weigh `weights` in turn and share `share` of all words.
    A target stops at `copies` times its source; the excess goes to the others by weight. So
    target = min(copies * size, weight * level), with one level for all that sums to the
    budget: sources fill in order of size / weight, and the level is set by the first that
    does not fill. `few` says that the sources fit one task.
    """
    # Spark compares strings by their UTF-8 bytes, that is by code point.
    place = [F.col("source").asc_nulls_last()]
    sizes = sizes.withColumn("_one", F.lit(1).cast("bigint"))
    ranked = _after(sizes, place, {"rank": "_one", "_first": "source_size"}, few).drop("_one")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    filled = ranked.withColumns(
        {
            "weight": F.element_at(turn, (F.col("rank") % len(weights) + 1).cast("int")),
            "cap": (F.col("source_size") * copies).cast("double"),
        }
    )
    filled = filled if few else store(filled, "mix-sources")
    all_words, all_weights = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = F.lit(float(all_words or 0) * float(share))
    order = [F.col("cap") / F.col("weight"), F.col("rank")]
    level = (budget - F.col("_filled")) / (F.lit(all_weights) - F.col("_weights"))
    levels = _after(filled, order, {"_filled": "cap", "_weights": "weight"}, few).withColumn("level", level)
    open_ = F.when(F.col("cap") > F.col("weight") * F.col("level"), F.col("level"))
    top = levels.agg(F.max(open_)).first()[0]
    target = F.col("cap") if top is None else F.least("cap", F.col("weight") * F.lit(top))
    return filled.select("source", "source_size", "rank", "_first", target.alias("target"))


def mixed(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    copies: int = COPIES,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 42,
    few_sources: int = FEW_SOURCES,
) -> DataFrame:
    """key, size, source_size, target and taken of every row of `docs`.

    Besides these: passes (how often it is taken) and _row (its shuffled place). Documents
    without words, NULL texts too, take nothing. Rows with equal keys are told apart by a hash
    of all columns; rows that repeat all are interchangeable, and each is queued. The same
    rows give the same mix in any partitioning. An empty table gives an empty result.
    """
    sized = store(
        docs.select(
            F.col(key).alias("key"),
            F.col(source).alias("source"),
            size_of(text).alias("size"),
            row_hash(docs, F.lit(seed)).alias("shuffle"),
        ),
        "mix-sizes",
    )
    sources = store(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_docs")),
        "mix-sources",
    )
    few = sources.count() <= few_sources
    table = store(targets(sources.drop("_docs"), weights, share, copies, few), "mix-targets")
    if few:
        named = table.withColumnRenamed("source", "_source")
        joined = sized.join(F.broadcast(named), F.col("source").eqNullSafe(F.col("_source")), "left")
    else:
        named = lookup_left_join(table, sources.select("source", "_docs"), ["source"])
        joined = attach(sized, named, ["source"], "_docs", F.col("shuffle")).drop("_docs")
    # Words before a document in all sources, taken in the order (source, shuffle), less those
    # of the sources before: a hot source is spread over as many ranges as its rows need.
    joined = joined.select("key", "size", "shuffle", "source_size", "rank", "_first", "target")
    order = [F.col(c) for c in ("rank", "shuffle", "key", "size")]
    queued = store(
        running_total(joined, order, "size", "_before", "mix-queue")
        .withColumn("_before", F.col("_before") - F.col("_first"))
        .drop("_first"),
        "mix-queued",
    )
    passes = [
        F.struct(
            F.try_divide(
                F.col("_before") + F.col("size") + F.col("source_size") * c, F.col("target")
            ).alias("finish"),
            "rank",
            "shuffle",
            "key",
            F.col("_before").alias("before"),
            F.lit(c).alias("pass"),
        )
        for c in range(copies)
    ]
    line = queued.where("size > 0").select("size", F.explode(F.array(*passes)).alias("place"))
    budget = F.lit(float(table.agg(F.sum("target")).first()[0] or 0.0))
    served = running_total(line, [F.col("place")], "size", "served", "mix-line")
    # Half a word covers the rounding of the targets' sum.
    last = (
        served.where(F.col("served") + F.col("size") <= budget + 0.5)
        .agg(F.max("place").alias("last"))
    )
    end = last.first()[0]
    fields = line.schema["place"].dataType.fields
    taken = F.lit(0)
    if end is not None:
        cut = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(end, fields, strict=True)])
        taken = sum(F.when((F.col("size") > 0) & (p <= cut), 1).otherwise(0) for p in passes)
    return queued.withColumn("passes", taken.cast("int")).select(
        F.col("key").alias(key),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("passes")).cast("bigint").alias("taken"),
        "passes",
        F.col("shuffle").alias("_row"),
    )


def mix(docs: DataFrame, key: str = "doc_id", seed: int = 42, **options) -> DataFrame:
    """The documents of the mix, with the columns of `docs`, once for every time taken."""
    shares = mixed(docs, key=key, seed=seed, **options)
    own, row, first, passes, copy, theirs = (
        unused(docs, n) for n in ("_own", "_row", "_first", "_passes", "_copy", "_key")
    )
    # Equal rows would meet each other; they are one row here, taken as often as all of them.
    taken = (
        shares.where("passes > 0")
        .groupBy(F.col(key).alias(theirs), F.col("_row").alias(row))
        .agg(F.sum("passes").cast("int").alias(passes))
    )
    rows = docs.withColumn(own, row_hash(docs, F.lit(seed)))
    once = W.partitionBy(key, own).orderBy(own)
    return (
        rows.join(taken, F.col(key).eqNullSafe(F.col(theirs)) & (F.col(own) == F.col(row)))
        .withColumn(first, F.row_number().over(once))
        .where(F.col(first) == 1)
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(passes))))
        .select(*[f"`{c}`" for c in docs.columns])
    )
