"""Exact deduplication with a cuckoo-filter index of live digests.

Texts are equal when their SHA-256 is, after lower-casing A-Z. The index has two tables,
bucketed by the first bytes of the digest: `filters` (one cuckoo filter a shard) and `keys`
(the stored digests with their number of live documents and the largest key among them).
Documents come in batches. A digest that misses its filter is new for certain and is stored; a
hit is verified against the stored keys of its bucket and counted there. Deleting the last document of a digest takes its entry out of the
filter. A filter that overflows is doubled and filled again from its stored keys; an index
that outgrows its shards is dealt to more, whose filters are made from the stored keys.

Only distinct digests, combined before the shuffle, reach a shard, so groups of copies of
any size cost a shard one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwise.llm import words
from offerwise.llm.columns import aside, with_results
from offerwise.llm.tables import attach, one_each, store

SLOTS = 4
MAX_KICKS = 200
FULLEST = 0.9
KEYS_PER_SHARD = 10_000
BATCHES = 3


class CuckooFilter:
    """16-bit marks of digests, each in one of two buckets of SLOTS; 0 is an empty slot."""

    def __init__(self, buckets: int, table: bytes | None = None):
        self.buckets = buckets
        if table is None:
            self.table = np.zeros((buckets, SLOTS), np.uint16)
        else:
            self.table = np.frombuffer(table, np.uint16).reshape(buckets, SLOTS).copy()

    @staticmethod
    def size_for(keys: int) -> int:
        """A power of two of buckets that holds `keys` with room to spare."""
        return 1 << max(2, int(np.ceil(np.log2(max(1, keys) / (SLOTS * FULLEST)))))

    def places(self, digests: np.ndarray):
        """(mark, first bucket, second bucket) of digests given as rows of 32 bytes."""
        lanes = np.ascontiguousarray(digests).view(np.uint64)
        mark = (lanes[:, 1] % np.uint64(0xFFFF) + np.uint64(1)).astype(np.uint16)
        first = (lanes[:, 2] & np.uint64(self.buckets - 1)).astype(np.int64)
        return mark, first, self._other(first, mark)

    def _other(self, bucket, mark):
        jump = words.mixed(np.atleast_1d(mark).astype(np.uint64)) & np.uint64(self.buckets - 1)
        return bucket ^ jump.astype(np.int64)

    def contains(self, digests: np.ndarray) -> np.ndarray:
        mark, first, second = self.places(digests)
        return (self.table[first] == mark[:, None]).any(1) | (self.table[second] == mark[:, None]).any(1)

    def insert(self, digests: np.ndarray) -> bool:
        """Add entries; False if some found no place (the filter must then be rebuilt)."""
        mark, first, second = self.places(digests)
        waiting = np.arange(len(mark))
        for bucket in [first, second] * SLOTS:
            # One newcomer a bucket at a time, while it has an empty slot.
            _, chosen = np.unique(bucket[waiting], return_index=True)
            chosen = waiting[chosen]
            empty = self.table[bucket[chosen]] == 0
            chosen, slot = chosen[empty.any(1)], empty[empty.any(1)].argmax(1)
            self.table[bucket[chosen], slot] = mark[chosen]
            waiting = np.setdiff1d(waiting, chosen, assume_unique=True)
            if not len(waiting):
                return True
        return all(self._kick(mark[i], int(first[i])) for i in waiting)

    def _kick(self, mark, bucket: int) -> bool:
        for kick in range(MAX_KICKS):
            row = self.table[bucket]
            if (free := np.flatnonzero(row == 0)).size:
                row[free[0]] = mark
                return True
            slot = kick % SLOTS
            row[slot], mark = mark, row[slot]
            bucket = int(self._other(bucket, mark)[0])
        return False

    def delete(self, digests: np.ndarray) -> None:
        """Take one entry of each digest out; the digests must have been inserted."""
        for mark, *both in zip(*self.places(digests), strict=True):
            for bucket in both:
                if (held := np.flatnonzero(self.table[bucket] == mark)).size:
                    self.table[bucket, held[0]] = 0
                    break


def filled(digests: np.ndarray, room_for: int) -> CuckooFilter:
    """A filter of stored keys, doubled until all have a place."""
    made = CuckooFilter(CuckooFilter.size_for(room_for))
    while not made.insert(digests):
        made = CuckooFilter(made.buckets * 2)
    return made


@dataclass
class Index:
    """Stored tables of the live digests, dealt to `shards`."""

    filters: DataFrame  # shard, buckets, marks
    keys: DataFrame  # shard, digest, n, keep
    shards: int


def digests(docs: DataFrame, text: str = "text", keep=None) -> DataFrame:
    """`docs` with `digest`: SHA-256 of the text with A-Z in lower case; NULL counts as empty."""

    def results(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for _, data, bounds in words.blocks(batch.column(0)):
            view = memoryview(words.lowered(data))
            ends = bounds.tolist()
            made = [hashlib.sha256(view[a:b]).digest() for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["digest"])

    return with_results(docs, [text], results, pa.schema([("digest", pa.binary())]), keep)


def grouped(prints: DataFrame, key: str) -> DataFrame:
    """One row a digest: n documents, and the largest key."""
    return prints.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(key).alias("keep"))


def _sharded(groups: DataFrame, shards: int) -> DataFrame:
    return groups.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int"))


def _larger(a, b):
    return b if a is None else a if b is None else max(a, b)


def _rows(digest) -> np.ndarray:
    return np.frombuffer(b"".join(digest), np.uint8).reshape(-1, 32)


def _changed(index: Index | None, groups: DataFrame, adding: bool) -> Index:
    """Bring `groups` (digest, n, keep) into the index: added to it, or put in its place."""
    shards = index.shards
    key_type = groups.schema["keep"].dataType.simpleString()
    # A shard's state is one table: a row a key, and a row with the filter (digest NULL).
    schema = f"shard int, digest binary, n bigint, keep {key_type}, buckets bigint, marks binary"
    blank = [F.lit(None).cast("bigint").alias("buckets"), F.lit(None).cast("binary").alias("marks")]
    state = index.keys.select("shard", "digest", "n", "keep", *blank).unionByName(
        index.filters.select(
            "shard",
            F.lit(None).cast("binary").alias("digest"),
            F.lit(None).cast("bigint").alias("n"),
            F.lit(None).cast(key_type).alias("keep"),
            "buckets",
            "marks",
        )
    )

    def apply(old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        shard = (old if len(old) else new)["shard"].iloc[0]
        # Keys may be of any type, and NULL: as objects they stay what they are.
        old, new = (t.assign(keep=t["keep"].astype(object).where(t["keep"].notna(), None)) for t in (old, new))
        holds = old[old["digest"].notna()].set_index("digest")[["n", "keep"]]
        marks = old[old["digest"].isna()]
        new = new.set_index("digest")[["n", "keep"]]
        if len(marks):
            seen = CuckooFilter(int(marks["buckets"].iloc[0]), marks["marks"].iloc[0])
        else:  # a new shard
            seen = filled(_rows(holds.index), len(holds) + len(new))
        # A miss is new; a hit is verified among the stored keys, as another digest may
        # have left the same mark.
        hit = seen.contains(_rows(new.index)) if len(new) else np.zeros(0, bool)
        stored = np.zeros(len(new), bool)
        stored[hit] = new.index[hit].isin(holds.index)
        known = new[stored]
        n, kept = known["n"], known["keep"]
        if adding:
            n = holds["n"].reindex(known.index) + n
            kept = pd.Series(
                map(_larger, holds["keep"].reindex(known.index), kept), known.index, object
            )
        gone = n.index[n == 0]
        if len(gone):
            seen.delete(_rows(gone))
        more = new[~stored & (new["n"] > 0).to_numpy()]
        changed = pd.DataFrame({"n": n, "keep": kept}).drop(gone)
        parts = [p for p in (holds.drop(known.index), changed, more) if len(p)]
        after = pd.concat(parts) if parts else holds
        crowded = len(after) > FULLEST * SLOTS * seen.buckets
        if len(more) and (crowded or not seen.insert(_rows(more.index))):
            seen = filled(_rows(after.index), 2 * len(after))
        out = pd.DataFrame(
            {
                "shard": shard,
                "digest": [None, *after.index],
                "n": pd.array([None, *after["n"]], "Int64"),
                "keep": pd.Series([None, *after["keep"]], dtype=object),
                "buckets": pd.array([seen.buckets, *[None] * len(after)], "Int64"),
                "marks": pd.Series([seen.table.tobytes(), *[None] * len(after)], dtype=object),
            }
        )
        return out

    made = store(
        state.groupBy("shard")
        .cogroup(_sharded(groups, shards).groupBy("shard"))
        .applyInPandas(apply, schema),
        "exact-index",
    )
    return Index(
        made.where(F.col("digest").isNull()).select("shard", "buckets", "marks"),
        made.where(F.col("digest").isNotNull()).select("shard", "digest", "n", "keep"),
        shards,
    )


def empty_index(spark, expected: int, key_type: str = "bigint") -> Index:
    """An index for about `expected` distinct digests; it grows as more are inserted."""
    return Index(
        spark.createDataFrame([], "shard int, buckets bigint, marks binary"),
        spark.createDataFrame([], f"shard int, digest binary, n bigint, keep {key_type}"),
        max(1, -(-expected // KEYS_PER_SHARD)),
    )


def insert(index: Index, groups: DataFrame) -> Index:
    """Add documents, given as `grouped` digests.

    Where the digests stored and to come could pass KEYS_PER_SHARD a shard, stored keys are
    dealt anew, and every shard makes its filter from them.
    """
    shards = -(-(index.keys.count() + groups.count()) // KEYS_PER_SHARD)
    if shards > index.shards:
        index = Index(index.filters.limit(0), _sharded(index.keys.drop("shard"), shards), shards)
    return _changed(index, groups, adding=True)


def delete(index: Index, gone: DataFrame, live: DataFrame, key: str) -> Index:
    """Take the digests `gone` of removed documents out, as far as no document in `live`
    (digests of all that remain) has them; otherwise n and keep follow those that do."""
    touched = gone.select("digest").distinct()
    left = grouped(live.join(touched, "digest", "left_semi"), key)
    groups = touched.join(left, "digest", "left").select(
        "digest", F.coalesce("n", F.lit(0)).alias("n"), "keep"
    )
    return _changed(index, groups, adding=False)


def lookup(index: Index, probes: DataFrame) -> DataFrame:
    """Distinct `probes` (digest) with n and keep of the index, NULL where it has none.

    Probes pass the shard's filter; only hits go on to the bucketed keys.
    """

    def probe(filters: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        hit = np.zeros(len(rows), bool)
        if len(filters) and len(rows):
            held = CuckooFilter(int(filters["buckets"].iloc[0]), filters["marks"].iloc[0])
            hit = held.contains(_rows(rows["digest"]))
        return rows[["shard", "digest"]].assign(hit=hit)

    probed = (
        index.filters.groupBy("shard")
        .cogroup(_sharded(probes.select("digest"), index.shards).groupBy("shard"))
        .applyInPandas(probe, "shard int, digest binary, hit boolean")
    )
    hits = probed.where("hit").join(index.keys, ["shard", "digest"], "left")
    return hits.select("digest", "n", "keep").unionByName(
        probed.where("not hit").select(
            "digest", F.lit(None).cast("bigint").alias("n"),
            F.lit(None).cast(index.keys.schema["keep"].dataType).alias("keep"),
        )
    )


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, keep_id, group_size, kept and text_sha256 of every row of `docs`.

    Documents are inserted into a new index in BATCHES batches: copies of one text come in
    different ones, and are found as verified hits. Each digest is looked up in the end. Of
    equal texts the largest key stays; NULL and empty texts are equal. NULL keys never are
    keep_id unless all of a group are NULL, and are then all kept, since nothing tells them
    apart. Rows that repeat a key and text are each kept or dropped alike. Very long texts are
    a digest like others; an empty table gives none.
    """
    prints = store(digests(docs, text, [key]), "exact-digests")
    index = empty_index(docs.sparkSession, 0, docs.schema[key].dataType.simpleString())
    batch = F.pmod(F.xxhash64(F.col(key), F.lit(1)), F.lit(BATCHES))
    seen = []
    for i in range(BATCHES):
        seen.append(store(grouped(prints.where(batch == i), key), "exact-groups"))
        index = insert(index, seen[-1])
    probes = reduce(DataFrame.unionByName, [groups.select("digest") for groups in seen]).distinct()
    found = store(lookup(index, probes), "exact-found")
    return attach(prints, found, ["digest"], "n", F.col(key)).select(
        key,
        F.col("keep").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("keep").eqNullSafe(F.col(key)).alias("kept"),
        F.hex("digest").alias("text_sha256"),
    ).withColumn("text_sha256", F.lower("text_sha256"))


def without_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one row of each group of equal texts: that with the largest key.

    Of rows that repeat key and text one stays.
    """
    kept = exact_duplicates(docs, key, text).where("kept")
    keepers = kept.select(key, F.unhex("text_sha256").alias("digest"))
    return aside(docs, ["digest"], lambda d: one_each(digests(d, text), keepers, [key, "digest"]))
