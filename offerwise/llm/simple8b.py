"""Token ids in Simple-8b words: 60 bits of payload and a 4-bit selector.

A selector says how many ids of how many bits a 64-bit word packs. An id too wide for any
selector is an escape: selector ESCAPE, and the id alone in the next word. Ids are cut into
blocks of BLOCK that start on a word of their own; the words before each block are stored,
so that blocks are decoded side by side.

A file's rows are groups of documents: their keys and numbers of ids, and the payload. As
Spark writes them, in any store it can reach, they are Parquet rows in order of the keys,
one range of keys a file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from offerwise.llm import bpe, words
from offerwise.session import scratch_path

# Ids a word holds, and bits of each, by selector. 15 is the escape.
COUNTS = np.array([240, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
ESCAPE = 15
BLOCK = 1024
LIMITS = (np.uint64(1) << WIDTHS.astype(np.uint64)) - np.uint64(1)
SMALL = 0xFFFF
FITS = np.searchsorted(LIMITS, np.arange(SMALL + 1, dtype=np.uint64)).astype(np.uint8)


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, words before each block and in all) of unsigned ids below 2**64."""
    ids = ids.astype(np.uint64)
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    # The narrowest width each id fits, block by block; padding fits any.
    narrow = np.zeros(blocks * BLOCK, np.uint8)
    narrow[:n] = np.searchsorted(LIMITS, ids) if ids.max() > SMALL else FITS[ids.astype(np.int64)]
    padded = np.zeros((blocks, BLOCK + COUNTS[0]), np.uint8)
    padded[:, :BLOCK] = narrow.reshape(blocks, BLOCK)
    # For each position: the first selector whose ids all fit, from the last one up.
    chosen_at = np.full((blocks, BLOCK), ESCAPE, np.uint8)
    for s in range(len(COUNTS) - 1, -1, -1):
        fits = padded <= s
        if not fits[:, :BLOCK].any():
            break
        span, count = 1, COUNTS[s]
        while span < count:  # all of the next `span` ids fit
            step = min(span, count - span)
            fits = fits[:, :-step] & fits[:, step:]
            span += step
        np.copyto(chosen_at, s, where=fits[:, :BLOCK])
    selector = chosen_at.reshape(-1)[:n]
    place = np.arange(n)
    taken = np.minimum(np.append(COUNTS, 1)[selector], BLOCK - place % BLOCK)
    taken = np.minimum(taken, n - place)
    # Follow the positions at which words start, in all blocks at once.
    at = np.arange(blocks) * BLOCK
    last = np.minimum(at + BLOCK, n)
    begins, of = [], []
    live = np.arange(blocks)
    while len(live):
        begins.append(at[live])
        of.append(live)
        at[live] += taken[at[live]]
        live = live[at[live] < last[live]]
    begin = np.concatenate(begins)
    order = np.argsort(begin, kind="stable")
    begin, block = begin[order], np.concatenate(of)[order]
    chosen, count = selector[begin], taken[begin]
    escaped = chosen == ESCAPE
    out = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen[~escaped]):
        mine = np.flatnonzero(chosen == s)
        for j in range(COUNTS[s] if WIDTHS[s] else 0):
            part = mine[count[mine] > j]
            if not len(part):
                break
            out[part] |= ids[begin[part] + j] << np.uint64(WIDTHS[s] * j)
    sizes = 1 + escaped.astype(np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    packed = np.zeros(starts[-1], np.uint64)
    packed[starts[:-1]] = out
    packed[starts[:-1][escaped] + 1] = ids[begin[escaped]]
    offsets = np.append(starts[np.searchsorted(block, np.arange(blocks))], starts[-1])
    return packed, offsets


def decode(packed: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The n ids that `encode` packed, all blocks side by side."""
    if not n:
        return np.zeros(0, np.uint64)
    chosen = (packed >> np.uint64(60)).astype(np.int64)
    # An escape's second word may look like any; walk the words of all blocks in step.
    blocks = len(offsets) - 1
    head = np.ones(len(packed), bool)
    if (chosen == ESCAPE).any():
        head[:] = False
        at, live = offsets[:-1].copy(), np.arange(blocks)
        while len(live):
            head[at[live]] = True
            at[live] += 1 + (chosen[at[live]] == ESCAPE)
            live = live[at[live] < offsets[live + 1]]
    heads = np.flatnonzero(head)
    selector = chosen[heads]
    counts = np.append(COUNTS, 1)[selector]
    # The last word of a block may hold fewer than its selector says.
    first = np.searchsorted(heads, offsets[:-1])
    before = np.concatenate(([0], np.cumsum(counts)))
    sizes = np.minimum(BLOCK, n - np.arange(blocks) * BLOCK)
    final = np.append(first[1:], len(heads)) - 1
    counts[final] = sizes - (before[final] - before[first])
    starts = np.concatenate(([0], np.cumsum(counts)))[:-1]
    out = np.zeros(n, np.uint64)
    for s in np.unique(selector):
        mine = np.flatnonzero(selector == s)
        if s == ESCAPE:
            out[starts[mine]] = packed[heads[mine] + 1]
            continue
        mask = np.uint64((1 << int(WIDTHS[s])) - 1)
        for j in range(COUNTS[s] if WIDTHS[s] else 0):
            part = mine[counts[mine] > j]
            if not len(part):
                break
            out[starts[part] + j] = (packed[heads[part]] >> np.uint64(WIDTHS[s] * j)) & mask
    return out


def write_tokens(
    docs: DataFrame,
    folder: str,
    path: str | None = None,
    end: int | None = 2,
    key: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode each text, append the id `end`, and write the ids in ascending order of `key`.

    NULL keys come last; equal keys are ordered by a hash of their text, so ranges split
    among them. NULL and empty texts hold the end id only. Texts, not ids, are moved to their
    ranges, so that nothing is encoded twice. An empty table gives a folder without rows.
    """
    path = path or public_tokenizers.path(bpe.VOCABULARY)
    order = [F.col(key).asc_nulls_last(), F.xxhash64(text).asc()]
    ranged = (
        docs.select(key, text)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order, F.col(text).asc())
        .select(F.col(key).alias("key"), F.col(text).alias("text"), F.spark_partition_id().alias("part"))
    )
    key_type = ranged.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = bpe.encoder(path)
        group = written = 0
        for batch in batches:
            for first, data, bounds in words.blocks(batch.column(1)):
                ids, at = bpe.encode_block(tool, data, bounds)
                if end is not None:
                    ids = np.insert(ids, at[1:], end)
                    at = at + np.arange(len(at))
                packed, offsets = encode(ids)
                keys = batch.column(0).slice(first, len(bounds) - 1)
                columns = [
                    batch.column(2).slice(first, 1),
                    pa.array([group], pa.int64()),
                    pa.array([written], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                    pa.array([np.diff(at)], pa.list_(pa.int64())),
                    pa.array([offsets], pa.list_(pa.int64())),
                    pa.array([packed.astype("<u8").tobytes()], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=NAMES)
                group += 1
                written += len(ids)

    ranged.mapInArrow(
        run,
        f"part int, `group` bigint, before bigint, keys array<{key_type}>, n_tokens array<bigint>,"
        " offsets array<bigint>, words binary",
    ).write.parquet(folder)


NAMES = ["part", "group", "before", "keys", "n_tokens", "offsets", "words"]


def read_tokens(spark: SparkSession, folder: str, key: str = "doc_id", ids: bool = False) -> DataFrame:
    """Per document of a folder: key, start (ids of all before it), n_tokens, ids_crc32 (of
    the ids as little-endian unsigned 32-bit integers) and, if asked for, the ids.

    Blocks are decoded where they lie. Only one number a file, its ids, is summed up across
    files to find where each starts.
    """
    groups = spark.read.parquet(folder)
    totals = groups.groupBy("part").agg(
        F.sum(F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("ids")
    )
    before = F.sum("ids").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    starts = totals.select("part", F.coalesce(before, F.lit(0)).alias("first"))
    key_type = groups.schema["keys"].dataType.elementType.simpleString()
    rows = groups.join(F.broadcast(starts), "part").select(
        (F.col("first") + F.col("before")).alias("start"), "keys", "n_tokens", "offsets", "words"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                counts = np.array(batch.column(2)[i].values, np.int64)
                offsets = np.array(batch.column(3)[i].values, np.int64)
                packed = np.frombuffer(batch.column(4)[i].as_buffer(), "<u8")
                found = decode(packed, offsets, int(counts.sum())).astype("<u4")
                cuts = np.concatenate(([0], np.cumsum(counts)))
                view = memoryview(found)
                sums = [zlib.crc32(view[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                columns = [
                    batch.column(1)[i].values,
                    pa.array(batch.column(0)[i].as_py() + cuts[:-1]),
                    pa.array(counts),
                    pa.array(sums, pa.int64()),
                ]
                names = [key, "start", "n_tokens", "ids_crc32"]
                if ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(found.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    listed = ", ids array<bigint>" if ids else ""
    return rows.mapInArrow(
        run, f"`{key}` {key_type}, start bigint, n_tokens bigint, ids_crc32 bigint{listed}"
    )


def packed_tokens(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write the tokens of `docs` to `folder` (by default a new one among the shared
    intermediate tables) and read them back."""
    folder = folder or scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, folder, **options)
    return read_tokens(docs.sparkSession, folder, options.get("key", "doc_id"))
