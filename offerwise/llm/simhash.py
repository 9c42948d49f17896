"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 2 bits have a value within 1 bit of both. So every
distinct fingerprint emits itself and its 64 one-bit variants, the shuffle brings equal
variants together, and neighbours in a variant's group (65 fingerprints at most) are
verified and linked. Groups are chained, not paired; links of one group share a component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from offerwise.llm import words
from offerwise.llm.columns import with_results
from offerwise.llm.components import components
from offerwise.llm.tables import attach, one_each, store, unused

BITS = 64
RADIUS = 2
SEED = 42


def shingles(data: np.ndarray, bounds: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The hashes of the shingles of `width` words, text by text of a block."""
    data = words.lowered(data)
    starts, ends, before = words.spans(data, bounds)
    lengths = ends - starts
    # The words one after the other, a space behind each.
    places = np.concatenate(([0], np.cumsum(lengths + 1)))
    spaced = np.full(places[-1], 0x20, np.uint8)
    spaced[words.gather(places[:-1], lengths)] = data[words.gather(starts, lengths)]
    view = memoryview(spaced)
    digest = xxhash.xxh64_intdigest
    for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        if a == b:
            yield np.zeros(0, np.uint64)
            continue
        last = max(b - width + 1, a + 1)
        begin = places[a:last].tolist()
        stop = (places[min(a + width, b) : b + 1] - 1).tolist()
        found = [digest(view[x:y], SEED) for x, y in zip(begin, stop, strict=True)]
        yield np.array(found, np.uint64)


_WEIGHTS = np.uint64(1) << np.arange(BITS, dtype=np.uint64)


def fingerprint(values: np.ndarray) -> np.uint64:
    """The SimHash of a text's shingles."""
    votes = np.zeros(BITS, np.int64)
    for part in np.array_split(values, 1 + len(values) // 50_000):
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return _WEIGHTS[2 * votes > len(values)].sum(dtype=np.uint64)


def fingerprint_block(data: np.ndarray, bounds: np.ndarray, width: int) -> np.ndarray:
    """The SimHash of each text of a block, over shingles of `width` words."""
    return np.array([fingerprint(v) for v in shingles(data, bounds, width)], np.uint64)


def fingerprints(docs: DataFrame, width: int, text: str = "text", keep=None) -> DataFrame:
    """`docs` with `simhash`, a long with the bits of the fingerprint."""

    def results(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for _, data, bounds in words.blocks(batch.column(0)):
            prints = fingerprint_block(data, bounds, width).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(prints)], names=["simhash"])

    return with_results(docs, [text], results, pa.schema([("simhash", pa.int64())]), keep)


def links(nodes: DataFrame, node: str = "simhash", radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b) that connect all distinct values of `node` with `radius` or fewer differing bits.

    Each emits its ball of half the radius: 65 variants at 2 bits, 2081 at 4.
    """
    if radius % 2:
        raise ValueError("radius is twice that of the balls, so it is even")
    f = F.col(node)
    flips = [
        sum(1 << i for i in bits)
        for n in range(radius // 2 + 1)
        for bits in combinations(range(BITS), n)
    ]
    variants = F.array(*[f.bitwiseXOR(F.lit(_signed(flip))) for flip in flips])
    balls = nodes.select(f.alias("b"), F.explode(variants).alias("variant"))
    chained = balls.withColumn("a", F.lag("b").over(W.partitionBy("variant").orderBy("b")))
    return (
        chained.where(F.col("a").isNotNull())
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
        .select("a", "b")
        .distinct()
    )


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def near_duplicates(
    docs: DataFrame, width: int = 3, key: str = "doc_id", text: str = "text", keep=(), radius: int = RADIUS
) -> DataFrame:
    """`key`, the columns `keep`, simhash and component_id (the smallest key linked, over any number of links).

    Texts are linked by fingerprints within `radius` bits. One row per row of `docs`. NULL and
    empty texts have fingerprint 0 and are linked like any other; NULL keys are ignored when
    the smallest is taken, so a component of NULL keys only has component_id NULL. Repeated
    rows stay and share a component. An empty table gives no rows.
    """
    prints = store(fingerprints(docs, width, text, [key, *keep]), "simhash")
    least = [F.min(key).alias("_low"), F.count(F.lit(1)).alias("_n")]
    nodes = store(prints.groupBy(F.col("simhash").alias("_node")).agg(*least), "simhash-nodes")
    roots = components(links(nodes, "_node", radius))
    rooted = nodes.join(roots.withColumnRenamed("node", "_node"), "_node", "left")
    lows = rooted.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("_low").alias("_least"))
    table = store(
        rooted.join(lows, "root", "left").select(
            F.col("_node").alias("simhash"), F.coalesce("_least", "_low").alias("component_id"), "_n"
        ),
        "simhash-components",
    )
    return attach(prints, table, ["simhash"], "_n", F.col(key)).drop("_n")


def without_near_duplicates(
    docs: DataFrame, width: int = 3, key: str = "doc_id", text: str = "text", radius: int = RADIUS
) -> DataFrame:
    """`docs` with one row of each component: that with the smallest key.

    Of rows that repeat key and text one stays. Rows with a NULL key stay where all their
    component has NULL keys. Columns may have any names; an empty table gives no rows.
    """
    print_ = unused(docs, "_print")
    marked = docs.withColumn(print_, F.xxhash64(text))
    found = near_duplicates(marked.select(key, text, print_), width, key, text, [print_], radius)
    keepers = found.where(F.col(key).eqNullSafe(F.col("component_id"))).select(key, print_)
    return one_each(marked, keepers, [key, print_]).select(*[f"`{c}`" for c in docs.columns])
