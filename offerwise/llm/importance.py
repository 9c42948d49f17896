"""Quality selection by importance resampling with hashed n-gram models.

Two bags of hashed one- and two-word n-grams are counted, over target texts and over all
texts. A text's log weight is the sum of log(target share / raw share) of its n-grams.
Adding Gumbel noise and taking the k largest draws k texts without replacement with
probabilities in proportion to their weights. The noise is a hash of key and seed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerwise.llm import words
from offerwise.llm.columns import with_results
from offerwise.llm.running import running_total
from offerwise.llm.tables import store

BUCKETS = 10_000


def _grams(data: np.ndarray, bounds: np.ndarray, buckets: int):
    """(text, bucket) of each word, and of each pair of neighbours in a text."""
    data = words.lowered(data)
    starts, ends, before = words.spans(data, bounds)
    found = words.hashes(data, starts, ends)
    texts = np.repeat(np.arange(len(bounds) - 1), np.diff(before))
    paired = np.flatnonzero(texts[1:] == texts[:-1])
    pairs = words.mixed(found[paired] * np.uint64(0x9E3779B97F4A7C15) + found[paired + 1])
    size = np.uint64(buckets)
    return (
        np.concatenate((texts, texts[paired])),
        np.concatenate((found % size, pairs % size)).astype(np.int64),
    )


def fit(docs: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text",
        buckets: int = BUCKETS, examples: int = 50_000) -> np.ndarray:
    """log(target share / raw share) of each bucket, each count plus one.

    The raw model counts all `docs`. The target model counts those whose key is in `targets`,
    at most `examples` of them (the smallest hashed keys): a bounded sample for the fit.
    """
    chosen = targets.select(F.col(key).alias("_key")).where("_key is not null").distinct()
    chosen = chosen.orderBy(F.xxhash64("_key"), "_key").limit(examples).withColumn("_target", F.lit(1))
    # At most `examples` keys are broadcast.
    rows = docs.select(key, text).join(F.broadcast(chosen), F.col(key) == F.col("_key"), "left").select(
        text, F.coalesce("_target", F.lit(0)).alias("_target")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            wanted = batch.column(1).to_numpy(zero_copy_only=False) == 1
            for first, data, bounds in words.blocks(batch.column(0)):
                texts, bucket = _grams(data, bounds, buckets)
                raw += np.bincount(bucket, minlength=buckets)
                target += np.bincount(bucket[wanted[first + texts]], minlength=buckets)
        columns = [pa.array(np.arange(buckets, dtype=np.int32)), pa.array(raw), pa.array(target)]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "raw", "target"])

    counted = rows.mapInArrow(count, "bucket int, raw bigint, target bigint")
    raw, target = np.ones(buckets), np.ones(buckets)
    for r in counted.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect():
        raw[r[0]] += r[1]
        target[r[0]] += r[2]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weighted(docs: DataFrame, ratios: np.ndarray, text: str = "text", keep=None) -> DataFrame:
    """`docs` with n_grams and log_weight; texts without words (NULL too) have 0 and 0.0."""
    sent = docs.sparkSession.sparkContext.broadcast(ratios)

    def results(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for _, data, bounds in words.blocks(batch.column(0)):
            texts, bucket = _grams(data, bounds, len(table))
            n = len(bounds) - 1
            columns = [
                pa.array(np.bincount(texts, minlength=n)),
                pa.array(np.bincount(texts, weights=table[bucket], minlength=n).astype(float)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["n_grams", "log_weight"])

    added = pa.schema([("n_grams", pa.int64()), ("log_weight", pa.float64())])
    return with_results(docs, [text], results, added, keep)


def gumbel(key: str, seed: int) -> Column:
    """-log(-log(u)), u in (0, 1) by a hash of the key."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(u))


def resampled(docs: DataFrame, ratios: np.ndarray, share: float, key: str = "doc_id",
              text: str = "text", seed: int = 42) -> DataFrame:
    """key, n_grams, log_weight, gumbel_key, rank (from 0) and selected of every row.

    The round(share * rows) largest gumbel_keys are selected; ties go by key, and rows that
    tie in both are interchangeable. Weights are rounded to 9 places, so that the order of
    summing cannot change a rank.
    """
    rows = store(
        weighted(docs.select(key, text), ratios, text, [key])
        .withColumn("log_weight", F.round("log_weight", 9))
        .withColumn("gumbel_key", F.col("log_weight") + gumbel(key, seed))
        .withColumn("_one", F.lit(1)),
        "importance",
    )
    k = round(share * rows.count())
    order = [F.col("gumbel_key").desc(), F.col(key).asc_nulls_last(), F.col("n_grams").asc()]
    ranked = running_total(rows, order, "_one", "rank", "importance-ranks")
    return ranked.withColumn("selected", F.col("rank") < k).drop("_one")
