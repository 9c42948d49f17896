"""One query for each operator over the whole of its table."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerwise.llm import (
    bpe,
    collocations,
    contamination,
    crf,
    exact,
    importance,
    mixing,
    neighbours,
    periodic,
    runindex,
    simhash,
    simple8b,
    toxicity,
)
from offerwise.llm.tables import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ROOT = str(Path(__file__).resolve().parents[2])


def reach(spark: SparkSession) -> None:
    """Let Python workers import this package from where it lies here, and keep what they get
    small. On a cluster that has it elsewhere, --py-files or the image provides it."""
    given = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in given.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [given, ROOT]))
    # Batches bounded by bytes: ten thousand long texts would not fit a worker.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    # Shuffle files go with the query that wrote them: what is needed again is stored.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def query(job: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(job)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reach(spark)
        return job(spark, sf_dir)

    QUERIES[job.__name__] = run
    return run


def held_out(divisor: int, remainder: int, key: str = "doc_id"):
    """Whether a document's row is kept out of learning; NULL keys are."""
    left = F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(divisor)) == remainder
    return F.coalesce(left, F.lit(True))


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir)).drop("_row", "passes")


@query
def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return neighbours.nearest(vectors, F.col("vec_id") % 20 == 0)


@query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(documents(spark, sf_dir))


@query
def op4_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learn = labels.where(~held_out(5, 0) & F.col("quality").isNotNull())
    share = learn.agg(F.avg("quality")).first()[0]
    ratios = importance.fit(docs, learn.where("quality = 1"))
    return importance.resampled(docs, ratios, 1.0 if share is None else share)


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learn = labels.where(~held_out(5, 0)).select("doc_id", F.col("toxic").alias("label"))
    index = toxicity.fit(docs, learn)
    return toxicity.scored(docs, index, keep=["doc_id"]).withColumn("held_out", held_out(5, 0))


@query
def op6_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runindex.without_repeats(documents(spark, sf_dir))


@query
def op7_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.packed_tokens(documents(spark, sf_dir))


@query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = crf.fit(docs, ~held_out(3, 1))
    found = crf.labelled(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return found.withColumn("held_out", held_out(3, 1))


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    digits = F.lower(F.lpad(F.hex("simhash"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(documents(spark, sf_dir).select("doc_id", "text")).drop("text")


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    seed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return periodic.digests(periodic.with_runs(docs, keep=["doc_id"], seed=seed))


@query
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination.contaminated(documents(spark, sf_dir), items, keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))
