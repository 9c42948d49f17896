"""Documents to training data: clean, deduplicate, mix and encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerwise.llm import bpe, exact, mixing, simhash, toxicity
from offerwise.llm.columns import aside
from offerwise.llm.queries import reach
from offerwise.llm.tables import documents
from offerwise.session import store

# Every stage's decision depends on code that SQL lacks.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    index = toxicity.fit(docs, labels.select("doc_id", F.col("toxic").alias("label")))
    names = toxicity.RESULT.names
    return aside(docs, names, lambda d: toxicity.scored(d, index).where("predicted = 0"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach(spark)
    return exact.without_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach(spark)
    return simhash.without_near_duplicates(docs, width=3, radius=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach(spark)
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach(spark)
    return bpe.encode_decode(docs).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("BPE", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the rows left, with their tokens counted and digested."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
