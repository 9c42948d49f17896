"""Approximate nearest neighbours by inner product with learned partitions.

On a bounded sample of the distinct vectors a neighbour graph is built and cut, again and
again, into balanced halves that few edges cross. A small network learns to tell in which
parts a vector's neighbours lie. It places every vector in its likeliest part and sends a
query to as many of the likeliest parts as the sample needs for the recall asked for; within
them all vectors are scored exactly, in blocks.

Equal vectors are one entry with its smallest ids, so that a very common vector costs no
more than another.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from offerwise.llm.columns import with_results
from offerwise.llm.tables import attach, store

GRAPH = 16
HIDDEN = 128
PER_ROOT = 7


@dataclass
class Router:
    """A one-layer network from a vector to scores of parts, and how many parts to search."""

    inner: np.ndarray
    bias: np.ndarray
    outer: np.ndarray
    offset: np.ndarray
    scale: float
    probes: int

    @property
    def parts(self) -> int:
        return len(self.offset)

    def scores(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x * self.scale) @ self.inner + self.bias, 0)
        return hidden @ self.outer + self.offset

    def likeliest(self, x: np.ndarray, count: int) -> np.ndarray:
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, :count]


def neighbour_graph(x: np.ndarray, k: int, step: int = 1024) -> np.ndarray:
    """The k nearest other rows of each row by inner product."""
    out = np.zeros((len(x), min(k, max(len(x) - 1, 0))), np.int64)
    for a in range(0, len(x), step):
        near = x[a : a + step] @ x.T
        near[np.arange(len(near)), np.arange(a, a + len(near))] = -np.inf
        if out.shape[1]:
            best = np.argpartition(-near, out.shape[1] - 1, axis=1)[:, : out.shape[1]]
            order = np.take_along_axis(-near, best, axis=1).argsort(axis=1, kind="stable")
            out[a : a + step] = np.take_along_axis(best, order, axis=1)
    return out


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """A part for each node, by repeated halving: sizes differ by a few, few edges are cut."""
    n = len(graph)
    left = np.repeat(np.arange(n), graph.shape[1])
    right = graph.ravel()
    left, right = np.concatenate((left, right)), np.concatenate((right, left))
    part = np.zeros(n, np.int64)
    random = np.random.default_rng(seed)
    for _ in range(int(np.log2(parts))):
        same = part[left] == part[right]
        a, b = left[same], right[same]
        degree = np.bincount(a, minlength=n) + 1e-9
        # The second eigenvector of the random walk, in all parts at once: average over
        # neighbours and take each part's mean out.
        x = random.standard_normal(n)
        size = np.bincount(part)
        for _ in range(60):
            x = 0.5 * x + 0.5 * np.bincount(a, x[b], n) / degree
            x -= (np.bincount(part, x) / size)[part]
            x /= np.sqrt(np.bincount(part, x * x) / size)[part] + 1e-12
        side = _upper_half(part, x)
        for _ in range(8):
            # Smooth towards the neighbours' side, then balance again.
            pull = np.bincount(a, np.where(side[b], 1.0, -1.0), n) / degree
            side = _upper_half(part, pull + 0.05 * x)
        part = 2 * part + side
    return part


def _upper_half(part: np.ndarray, x: np.ndarray) -> np.ndarray:
    order = np.lexsort((x, part))
    size = np.bincount(part)
    first = np.concatenate(([0], np.cumsum(size)))[:-1]
    side = np.zeros(len(part), bool)
    side[order] = np.arange(len(part)) - first[part[order]] >= size[part[order]] // 2
    return side


def learn(x: np.ndarray, parts: int, recall: float, k: int = 20, rounds: int = 150) -> Router:
    """Cut the sample's neighbour graph, train the router, and choose the number of probes."""
    norms = np.sqrt((x * x).sum(axis=1))
    top = norms.max() if len(x) else 1.0
    scale = float(np.sqrt(x.shape[1]) / max(norms.mean() if len(x) else 1.0, 1e-30))
    parts = max(1, min(parts, 1 << int(np.log2(max(1, len(x) // 32)))))
    random = np.random.default_rng(11)
    router = Router(
        random.standard_normal((x.shape[1], HIDDEN)) * np.sqrt(2 / x.shape[1]),
        np.zeros(HIDDEN),
        random.standard_normal((HIDDEN, parts)) * np.sqrt(1 / HIDDEN),
        np.zeros(parts),
        scale,
        1,
    )
    if parts == 1:
        return router
    # One more coordinate makes all vectors equally long: inner products become cosines.
    lifted = np.column_stack((x, np.sqrt(np.maximum(top * top - norms * norms, 0))))
    graph = neighbour_graph(lifted, GRAPH)
    part = balanced_parts(graph, parts)
    wanted = np.zeros((len(x), parts))
    np.add.at(wanted, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1.0)
    np.add.at(wanted, (np.arange(len(x)), part), 1.0)
    wanted /= wanted.sum(axis=1, keepdims=True)
    weights = [router.inner, router.bias, router.outer, router.offset]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for t in range(1, rounds + 1):
        some = random.permutation(len(x))[:1024]
        given = x[some] * scale
        hidden = np.maximum(given @ router.inner + router.bias, 0)
        out = hidden @ router.outer + router.offset
        out = np.exp(out - out.max(axis=1, keepdims=True))
        miss = (out / out.sum(axis=1, keepdims=True) - wanted[some]) / len(some)
        back = (miss @ router.outer.T) * (hidden > 0)
        slopes = [given.T @ back, back.sum(axis=0), hidden.T @ miss, miss.sum(axis=0)]
        for w, s, m, v in zip(weights, slopes, first, second, strict=True):
            m += 0.1 * (s - m)
            v += 0.01 * (s * s - v)
            w -= 0.01 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    # How far down a query's list of parts its true neighbours lie, as the router places them.
    queries = random.permutation(len(x))[:1024]
    near = x[queries] @ x.T
    near[np.arange(len(queries)), queries] = -np.inf
    k = min(k, len(x) - 1)
    true = np.argpartition(-near, k - 1, axis=1)[:, :k]
    placed = router.likeliest(x, 1)[:, 0]
    order = router.likeliest(x[queries], parts)
    depth = np.argsort(order, axis=1)
    reached = np.take_along_axis(depth, placed[true], axis=1)
    shares = np.array([(reached < m).mean() for m in range(1, parts + 1)])
    router.probes = int(np.argmax(shares >= min(recall, shares[-1]))) + 1
    return router


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def usable(vec: str) -> Column:
    """No NULL or non-finite component, and not zero."""
    v = F.col(vec)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    key: str = "vec_id",
    vec: str = "embedding",
    sample: int = 8192,
    recall: float = 0.95,
    block: int = 4096,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k nearest other rows of each query.

    Rows whose vector is NULL, zero or has a NULL or non-finite component take no part, nor
    do rows with a NULL key. Vectors of unlike length cannot be compared: each length is
    searched on its own, one after the other. Ties go to the smaller key. Keys that repeat with one vector are each a row. The
    router is fitted on `sample` distinct vectors (those with the smallest hashes), which also
    bounds the parts, of which there are about sqrt(vectors) / PER_ROOT, to sample / 32; every vector is placed and can be found.
    """
    rows = store(
        vectors.where(usable(vec) & F.col(key).isNotNull()).select(
            F.col(key).alias("id"),
            F.col(vec).cast("array<double>").alias("vec"),
            F.size(vec).alias("width"),
            F.xxhash64(vec).alias("h"),
            F.xxhash64(F.lit(1), vec).alias("g"),
            is_query.alias("asked"),
        ),
        "ann-rows",
    )
    # One row a length; tables have one or a few.
    widths = sorted(r[0] for r in rows.select("width").distinct().collect()) or [1]
    found = [
        _nearest(rows.where(F.col("width") == w).drop("width"), w, k, sample, recall, block)
        for w in widths
    ]
    return reduce(DataFrame.unionByName, found)


def _nearest(rows: DataFrame, width: int, k: int, sample: int, recall: float, block: int) -> DataFrame:
    """`nearest` among rows (id, vec, h, g, asked) whose vectors have length `width`."""
    # The k + 1 smallest ids of each vector; the limit also works before the shuffle.
    smallest = rows.withColumn("n", F.row_number().over(W.partitionBy("h", "g").orderBy("id")))
    members = store(
        smallest.where(F.col("n") <= k + 1)
        .groupBy("h", "g")
        .agg(F.array_sort(F.collect_list("id")).alias("ids"), F.first("vec").alias("vec")),
        "ann-members",
    )
    distinct = members.count()
    asked = store(
        rows.where("asked").groupBy("h", "g").agg(F.count(F.lit(1)).alias("times")), "ann-asked"
    )
    picked = members.orderBy("h", "g").limit(sample).select("vec").toArrow()  # bounded
    x = _matrix(picked["vec"].combine_chunks(), width) if picked.num_rows else np.zeros((0, width))
    parts = 1 << max(0, round(np.log2(max(1.0, np.sqrt(distinct) / PER_ROOT))))
    router = learn(x, parts, recall, k)
    sent = rows.sparkSession.sparkContext.broadcast(router)

    def route(count: int):
        def results(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            chosen = sent.value.likeliest(_matrix(batch.column(0), width), count)
            column = pa.ListArray.from_arrays(
                pa.array(np.arange(len(chosen) + 1) * chosen.shape[1], pa.int32()),
                pa.array(chosen.ravel(), pa.int32()),
            )
            yield pa.RecordBatch.from_arrays([column], names=["parts"])

        return results

    schema = pa.schema([("parts", pa.list_(pa.int32()))])
    placed = store(
        with_results(members, ["vec"], route(1), schema).select(
            "h", "g", "vec", F.col("ids")[0].alias("low"), F.col("parts")[0].alias("part")
        ),
        "ann-placed",
    )
    routed = store(
        with_results(members.join(asked, ["h", "g"], "left_semi"), ["vec"], route(router.probes), schema)
        .select("h", "g", "vec", F.explode("parts").alias("part")),
        "ann-routed",
    )
    # Parts are cut into blocks of vectors and blocks of queries; one small row a part.
    blocks = (
        placed.groupBy("part")
        .agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("v_blocks"))
        .join(
            routed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("q_blocks")),
            "part",
        )
    )
    spread = F.broadcast(store(blocks, "ann-blocks"))

    def over(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    def within(count: str) -> Column:
        # Of the type of `over`: groups of unlike key types would not meet.
        return F.pmod("h", count).cast("int")

    held = placed.join(spread, "part").select(
        "part", "h", "g", "vec", "low",
        within("v_blocks").alias("v"), over("q_blocks").alias("q"),
    )
    questions = routed.join(spread, "part").select(
        "part", "h", "g", "vec", within("q_blocks").alias("q"), over("v_blocks").alias("v")
    )
    key_type = rows.schema["id"].dataType.simpleString()

    def search(queries: pa.Table, entries: pa.Table) -> pa.Table:
        return _best(queries, entries, k + 1, width)

    keys = ["part", "v", "q"]
    found = (
        questions.groupBy(*keys)
        .cogroup(held.groupBy(*keys))
        .applyInArrow(search, f"qh bigint, qg bigint, h bigint, g bigint, low {key_type}, score double")
    )
    best = W.partitionBy("qh", "qg").orderBy(F.desc("score"), "low")
    kept = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    listed = (
        kept.join(members.select("h", "g", "ids"), ["h", "g"])
        .select("qh", "qg", "score", F.explode("ids").alias("id"))
        .withColumn("n", F.row_number().over(W.partitionBy("qh", "qg").orderBy(F.desc("score"), "id")))
        .where(F.col("n") <= k + 1)
        .groupBy(F.col("qh").alias("h"), F.col("qg").alias("g"))
        .agg(F.array_sort(F.collect_list(F.struct("n", "id", "score"))).alias("found"))
        .join(asked, ["h", "g"])
    )
    answers = attach(
        rows.where("asked").select("id", "h", "g"), store(listed, "ann-found"), ["h", "g"], "times", F.col("id")
    )
    # A query's own row is the one entry with its id (one of them, if ids repeat).
    others = answers.select(
        F.col("id").alias("query_id"),
        "found",
        F.array_position(F.transform("found", lambda f: f["id"]), F.col("id")).alias("own"),
    ).select(
        "query_id",
        F.posexplode(
            F.slice(
                F.filter("found", lambda f, i: (F.col("own") == 0) | (i != F.col("own") - 1)), 1, k
            )
        ),
    )
    return others.select(
        "query_id", (F.col("pos") + 1).alias("rank"), F.col("col.id").alias("vec_id"), "col.score"
    )


def _best(queries: pa.Table, entries: pa.Table, k: int, width: int, step: int = 256) -> pa.Table:
    """The k best entries of each query in a block, scored in double precision."""
    names = ["qh", "qg", "h", "g", "low", "score"]
    low = entries["low"].combine_chunks()
    if not queries.num_rows or not entries.num_rows:
        rows = which = np.zeros(0, np.int64)
        scores = np.zeros(0)
    else:
        x = _matrix(entries["vec"].combine_chunks(), width)
        q = _matrix(queries["vec"].combine_chunks(), width)
        order = np.argsort(np.array(low.to_pylist()), kind="stable")
        wide = min(len(x), k + 16)
        got = []
        for a in range(0, len(q), step):
            near = q[a : a + step] @ x.T
            best = np.argpartition(-near, wide - 1, axis=1)[:, :wide] if wide < len(x) else np.tile(np.arange(len(x)), (len(near), 1))
            # The order of a matrix product's sums varies with its shape; these are fixed.
            exact = (q[a : a + step, None, :] * x[best]).sum(axis=2)
            place = np.empty(len(x), np.int64)
            place[order] = np.arange(len(x))
            final = np.lexsort((place[best], -exact), axis=1)[:, :k]
            line = np.repeat(np.arange(a, a + len(near)), final.shape[1])
            got.append((line, np.take_along_axis(best, final, 1).ravel(), np.take_along_axis(exact, final, 1).ravel()))
        rows, which, scores = (np.concatenate(c) for c in zip(*got, strict=True))
    pick, take = pa.array(rows), pa.array(which)
    columns = [queries["h"].take(pick), queries["g"].take(pick), entries["h"].take(take), entries["g"].take(take), entries["low"].take(take), pa.array(scores)]
    return pa.table(columns, names=names)
