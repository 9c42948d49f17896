"""Phrase collocations by dynamic itemset counting.

Documents are dealt over shards that are read again and again in turn; a step reads one shard.
Words are counted from the first step on. A longer phrase is counted from the step after both
its longest parts, without its last and without its first word, have reached the threshold, and
for one full cycle of shards; so lengths are counted side by side, and every count is of the
whole table. Whatever reaches the threshold does so within its own cycle, hence in the last
cycle at the latest everything longer has begun, and the counting ends.

Which phrases have reached the threshold, and at which step, is one byte for each of 2^bits
slots, to which phrases are hashed: a table of fixed size that goes to all tasks. Phrases that
share a slot can only begin early, which costs counting but changes no count. The counts
themselves never leave Spark: tasks combine theirs before they are shuffled by phrase, and only
those still in their cycle are carried on to the next step.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from offerwise.llm.tables import attach, store
from offerwise.llm.words import blocks, gather, hashes, lowered, mixed
from offerwise.session import scratch_path

LEAST = 30
LONGEST = 4
TOP = 2000
SHARDS = 2
BITS = 25
BLOCK_BYTES = 4 << 20
HASH_BYTES = 1 << 20

# A candidate goes if this share (of 100) of its occurrences lie in one longer phrase.
COVERED = 80
SCALE = 2_000_000

NEVER = 255

_COUNTS = pa.schema(
    [("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.string()), ("begin", pa.int32()), ("f", pa.int64())]
)
_KEY = ["lang", "k", "phrase"]

# Bytes that end a piece of text, and those that only end a word.
_ENDS_PIECE = np.zeros(256, bool)
_ENDS_PIECE[list(b".,;:!?\n\x0b\x0c\r")] = True
_ENDS_WORD = _ENDS_PIECE.copy()
_ENDS_WORD[list(b" \t")] = True

_STEP = np.uint64(0x9E3779B97F4A7C15)


def pieces(data: np.ndarray, bounds: np.ndarray):
    """(starts, ends, piece, text) of each word; words of one piece of one text share `piece`."""
    inside = ~_ENDS_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    begin = inside & edge[:-1]
    begin[1:] |= inside[1:] & ~inside[:-1]
    finish = inside & edge[1:]
    finish[:-1] |= inside[:-1] & ~inside[1:]
    starts = np.flatnonzero(begin)
    text = np.searchsorted(bounds, starts, "right") - 1
    # A text's end ends its last piece, too.
    return starts, np.flatnonzero(finish) + 1, np.cumsum(_ENDS_PIECE[data])[starts] + text, text


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: of its first and last eight bytes, which are all of a word of
    up to 16, or of all bytes of a longer one. In parts, as there are eight bytes for each byte."""
    out = np.empty(len(starts), np.uint64)
    cuts = np.searchsorted(starts, np.arange(HASH_BYTES, len(data), HASH_BYTES))
    for part in np.split(np.arange(len(starts)), cuts):
        if not len(part):
            continue
        base, stop = starts[part[0]], ends[part[-1]]
        eight = np.zeros(stop - base + 8, np.uint64)
        eight[: stop - base] = data[base:stop]
        for reach in (1, 2, 4):
            eight[:-reach] |= eight[reach:] << np.uint64(8 * reach)
        first, size = starts[part] - base, ends[part] - starts[part]
        bits = (8 * np.minimum(size, 8)).astype(np.uint64)
        head = eight[first] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - bits))
        tail = np.where(size > 8, eight[np.maximum(first + size - 8, 0)], np.uint64(0))
        out[part] = mixed(mixed(head + size.astype(np.uint64) * _STEP) + tail)
    long = np.flatnonzero(ends - starts > 16)
    size = ends[long] - starts[long]
    bounds = np.concatenate(([0], np.cumsum(size)))
    letters = data[gather(starts[long], size)]
    out[long] = hashes(letters, bounds[:-1], bounds[1:])
    return out


def _longer(first: np.ndarray, last_word: np.ndarray) -> np.ndarray:
    """Hashes of phrases, from those without the last word and of that word."""
    return mixed(first * _STEP + last_word)


def _lang_hashes(langs: pa.Array) -> np.ndarray:
    return np.concatenate(
        [hashes(d, b[:-1], b[1:]) for _, d, b in blocks(langs)] or [np.zeros(0, np.uint64)]
    )


def _texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, k: int) -> pa.Array:
    """The phrases of k words from each word `at`, joined by one space."""
    sizes = [ends[at + j] - starts[at + j] for j in range(k)]
    bounds = np.concatenate(([0], np.cumsum(sum(sizes) + k - 1)))
    out = np.full(int(bounds[-1]), 0x20, np.uint8)
    to = bounds[:-1].copy()
    for j, size in enumerate(sizes):
        out[gather(to, size)] = data[gather(starts[at + j], size)]
        to += size + 1
    buffers = [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(out)]
    return pa.Array.from_buffers(pa.string(), len(at), buffers)


def _counted(
    langs: pa.Array, texts: pa.Array, step: int, cycle: int, reached: np.ndarray, longest: int
) -> Iterator[pa.RecordBatch]:
    """Counts, a block of texts at a time, of the phrases that are in their cycle at this step."""
    shift = np.uint64(64 - (len(reached).bit_length() - 1))
    of_lang = _lang_hashes(langs)
    for first, data, bounds in blocks(texts, BLOCK_BYTES):
        data = lowered(data)
        starts, ends, piece, text = pieces(data, bounds)
        word = _longer(of_lang[first + text], _word_hashes(data, starts, ends))
        phrase, since = word, np.zeros(len(word), np.int32)
        for k in range(1, longest + 1):
            if k > 1:
                when = reached[(phrase >> shift).astype(np.int64)].astype(np.int32)
                since = np.maximum(when[:-1], when[1:])
                since[piece[k - 1 :] != piece[: len(since)]] = NEVER
                if not (since <= step).any():
                    break
                phrase = _longer(phrase[:-1], word[k - 1 :])
            at = np.flatnonzero((since <= step) & (step < since + cycle))
            if not len(at):
                if len(phrase) < 2:
                    break
                continue
            _, one, counts = np.unique(phrase[at], return_index=True, return_counts=True)
            one = at[one]
            yield pa.RecordBatch.from_arrays(
                [
                    langs.take(pa.array(first + text[one])),
                    pa.array(np.full(len(one), k, np.int32)),
                    _texts(data, starts, ends, one, k),
                    pa.array(since[one]),
                    pa.array(counts, pa.int64()),
                ],
                schema=_COUNTS,
            )
            if len(phrase) < 2:
                break


@lru_cache(maxsize=1)
def _unpacked(table: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(table), np.uint8)


def _slots(batch: pa.RecordBatch, bits: int) -> pa.RecordBatch:
    """Slots, from 1, of phrases given as texts."""
    of_lang, found = _lang_hashes(batch.column(0)), []
    for first, data, bounds in blocks(batch.column(1)):
        starts, ends, _, text = pieces(data, bounds)
        word = _longer(of_lang[first + text], _word_hashes(data, starts, ends))
        begin = np.searchsorted(text, np.arange(len(bounds)))
        phrase, sizes = word[begin[:-1]], np.diff(begin)
        for j in range(1, int(sizes.max(initial=1))):
            more = sizes > j
            phrase[more] = _longer(phrase[more], word[begin[:-1][more] + j])
        found.append((phrase >> np.uint64(64 - bits)).astype(np.int64) + 1)
    slots = np.concatenate(found or [np.zeros(0, np.int64)])
    return pa.RecordBatch.from_arrays([pa.array(slots, pa.int64())], names=["slot"])


def _mark(reached: np.ndarray, phrases: DataFrame, bits: int, step: int) -> bool:
    """Note the step at which the slots of `phrases` (lang, phrase) were first reached."""
    slots = phrases.select("lang", "phrase").mapInArrow(
        lambda batches: (_slots(b, bits) for b in batches), "slot bigint"
    )
    # At most 2^bits / 32768 bitmaps of 4 KB reach the driver.
    maps = slots.groupBy(F.bitmap_bucket_number("slot").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    new = False
    for part, packed in maps.collect():
        here = reached[(part - 1) << 15 : part << 15]
        fresh = np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little")[: len(here)] == 1
        fresh &= here == NEVER
        here[fresh] = step
        new |= bool(fresh.any())
    return new


def _dealt(docs: DataFrame, text: str, group: str, shards: int) -> list[DataFrame]:
    """The texts and groups of `docs`, stored in shards of like size."""
    path = scratch_path(docs.sparkSession, "shards")
    rows = docs.select(
        F.coalesce(F.col(f"`{group}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    dealt = rows.withColumn("shard", F.monotonically_increasing_id() % shards)
    dealt.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    table = docs.sparkSession.read.schema("lang string, text string, shard long").parquet(path)
    return [table.where(F.col("shard") == i).select("lang", "text") for i in range(shards)]


def frequent(
    docs: DataFrame,
    text: str = "text",
    group: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    shards: int = SHARDS,
    bits: int = BITS,
) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, f) of all phrases of up to `longest` words that occur `least` times in
    their group, and (lang, n) with all words of each group."""
    if shards * longest >= NEVER:
        raise ValueError("more steps than a byte counts")
    spark = docs.sparkSession
    tables = _dealt(docs, text, group, shards)
    reached = np.full(1 << bits, NEVER, np.uint8)
    state, words, done, last, step = None, None, [], 0, 0
    while step < last + shards:
        # Mostly NEVER, and packed small on its way; a task's worker unpacks it once a step.
        held = spark.sparkContext.broadcast(zlib.compress(reached, 1))

        def scan(batches, step=step, held=held):
            table = _unpacked(held.value)
            for b in batches:
                yield from _counted(b.column(0), b.column(1), step, shards, table, longest)

        counts = tables[step % shards].mapInArrow(
            scan, "lang string, k int, phrase string, begin int, f bigint"
        )
        if state is not None:
            counts = counts.unionByName(state.where(F.col("begin") > step - shards))
        state = store(counts.groupBy(*_KEY, "begin").agg(F.sum("f").alias("f")), "counts")
        often = state.where(F.col("f") >= least)
        if _mark(reached, often.where(F.col("k") < longest), bits, step + 1):
            last = step + 1
        if step == shards - 1:
            words = store(
                state.where("k = 1").groupBy("lang").agg(F.sum("f").alias("n")), "words-of-groups"
            )
        if step >= shards - 1:
            ended = often.where(F.col("begin") == step - shards + 1)
            done.append(store(ended.select(*_KEY, "f"), "frequent"))
        held.destroy()
        step += 1
    return reduce(DataFrame.unionByName, done), words


def _wide(column: str):
    """A long with room for its products."""
    return F.col(column).cast("decimal(20,0)")


def scored(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, k, a, l, r, score) of the phrases (lang, k, phrase, f) of two words or more:
    the parts' counts and the score of the lowest-scoring cut, of equal ones the earliest."""
    several = phrases.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"))
    cut = several.withColumn("word", F.split("phrase", " ")).withColumn(
        "cut", F.explode(F.expr("sequence(1, k - 1)"))
    )
    side = lambda name, part: F.struct(F.lit(name).alias("side"), F.array_join(part, " ").alias("part"))
    parts = cut.select(
        "lang", "phrase", "k", "a", "cut",
        F.inline(
            F.array(
                side("l", F.slice("word", 1, F.col("cut"))),
                side("r", F.slice("word", F.col("cut") + 1, F.col("k"))),
            )
        ),
    )
    asked = parts.groupBy("lang", "part").agg(F.count("*").alias("asked"))
    known = store(
        asked.join(phrases.select("lang", F.col("phrase").alias("part"), "f"), ["lang", "part"]), "parts"
    )
    found = attach(parts, known, ["lang", "part"], "asked", F.concat("phrase", "cut", "side"))
    counts = {s: F.max(F.when(F.col("side") == s, F.col("f"))).alias(s) for s in ("l", "r")}
    cuts = found.groupBy("lang", "phrase", "k", "a", "cut").agg(*counts.values())
    score = F.expr(f"cast({SCALE} as decimal(8,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + r)")
    best = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "k", "a").agg(best).select(
        "lang", "phrase", "k", "a", "best.l", "best.r", "best.score"
    )


def collocations(
    docs: DataFrame,
    text: str = "text",
    group: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    shards: int = SHARDS,
    bits: int = BITS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each group's first `top` phrases.

    A-Z are lowered; texts are cut into pieces at .,;:!? and line ends, pieces into words at
    spaces and tabs. a, l and r count a phrase and the two parts of its lowest-scoring cut,
    within pieces, overlaps included; n counts the group's words; score is
    floor(2000000 a / (l + r)). A phrase goes if one longer phrase holds 80 % of its
    occurrences; it is enough to look at those of one word more, since whatever holds a longer
    one holds it too. NULL texts are empty and count nothing; a NULL group is `und`, together
    with groups of that name. Very long texts are read whole. Equal scores go by a, then by the
    phrase's bytes, so that there are no ties. Repeated rows count as often as they are there.
    Tables without words give no rows. Other columns are not read.
    """
    phrases, words = frequent(docs, text, group, least, longest, shards, bits)
    longer = phrases.where("k > 2").withColumn("word", F.split("phrase", " "))
    shorter = F.array(
        F.expr("array_join(slice(word, 1, k - 1), ' ')"), F.expr("array_join(slice(word, 2, k - 1), ' ')")
    )
    within = (
        longer.select("lang", F.explode(shorter).alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("within"))
    )
    kept = scored(phrases).join(within, ["lang", "phrase"], "left").where(
        F.col("within").isNull() | (_wide("within") * 100 < _wide("a") * COVERED)
    )
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select(
        "lang", F.col("rank").cast("bigint"), "phrase", "a", "l", "r", "n", F.col("score").cast("bigint")
    )
