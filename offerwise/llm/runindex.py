"""Long repeats across documents by a run-length index.

A run-compressed Burrows-Wheeler transform with suffix positions sampled at the ends of its
runs answers matching statistics: texts are streamed through it backwards, all at once, each
keeping one place in the transform and the length matched there; where the next byte differs
from the run at hand, the nearer ends of the neighbouring runs of that byte take over, by the
longer common extension. Stretches of suffixes that share SPAN bytes hold the smallest
document among them, so a match of SPAN bytes tells whether an earlier document has it.

One index cannot hold a corpus, so strings are first brought together that can match:

* Of the K-byte grams inside every SPAN-byte string the least by hash is its anchor. Equal
  strings have equal anchors, so only documents that share an anchor can share a string.
* The strings of one anchor's occurrence overlap in one context. Contexts are made for
  anchors that two different texts have; equal contexts are one, with its smallest document.
* Contexts are dealt out by anchor to shards that are indexed each on its own. An anchor of
  over CROWD contexts would fill a shard: its contexts are cut into their strings, and the
  smallest document of each is taken by a grouped minimum, combined before it is shuffled.

Equal texts are one text throughout.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwise.llm import words
from offerwise.llm.columns import with_results
from offerwise.llm.tables import attach, store, store_dense

SPAN = 50
K = 24
WINDOWS = SPAN - K + 1
BUCKET = 200_000
CROWD = 100

# What a task's Python holds besides its batch follows these: bytes of text at a time, contexts
# of an index (some 9 kB each), and crowded contexts whose strings are made at a time.
BLOCK = 1 << 18
SHARD = 3_000
STRINGS_OF = 512

# One odd factor for each word of a gram.
_FACTORS = np.random.default_rng(50).integers(0, 1 << 63, K // 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SAMPLED = 16
FREQUENT = 500


# -- anchors ---------------------------------------------------------------------------------


def _grams(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the K bytes from each byte on, from their three words of eight bytes."""
    word = data.astype(np.uint64)
    for reach in (1, 2, 4):
        word = word[:-reach] | (word[reach:] << np.uint64(8 * reach))
    n = len(data) - K + 1
    mixed = word[:n] * _FACTORS[0]
    for i in range(1, K // 8):
        mixed += word[8 * i : 8 * i + n] * _FACTORS[i]
    return words.mixed(mixed)


def anchors(data: np.ndarray, bounds: np.ndarray):
    """(hash, text, first string, last string) of each anchor of the texts of a block.

    Strings are given by their first byte, counted from the text's start.
    """
    none = np.zeros(0, np.int64)
    if len(data) < SPAN:
        return np.zeros(0, np.uint64), none, none, none
    value = _grams(data)
    # The hash's upper bits and the place in one number: of equal ones the first is the least.
    low = (np.uint64(1) << np.uint64(int(len(value)).bit_length())) - np.uint64(1)
    least, span = (value & ~low) | np.arange(len(value), dtype=np.uint64), 1
    while span < WINDOWS:
        step = min(span, WINDOWS - span)
        least = np.minimum(least[step:], least[:-step])
        span += step
    # Strings that would run over a text's end are none.
    crossing = np.zeros(len(least) + SPAN + 1, np.int32)
    np.add.at(crossing, np.maximum(bounds[1:] - SPAN + 1, bounds[:-1]), 1)
    np.add.at(crossing, bounds[1:], -1)
    start = np.flatnonzero(np.cumsum(crossing[: len(least)]) == 0)
    if not len(start):
        return np.zeros(0, np.uint64), none, none, none
    place = (least[start] & low).astype(np.int64)
    fresh = np.ones(len(start), bool)
    fresh[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(start)) - 1
    of = np.searchsorted(bounds, start[first], "right") - 1
    return value[place[first]], of, start[first] - bounds[of], start[last] - bounds[of]


# -- the index -------------------------------------------------------------------------------


class RunIndex:
    """Strings, each with a number `doc`, behind a run-compressed transform."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, doc: np.ndarray):
        lengths = np.diff(ends)
        n = len(data) + len(lengths)
        # Each string and a terminator, which sorts first and by string.
        self.first = ends[:-1] + np.arange(len(lengths))
        self.last = self.first + lengths
        text = np.zeros(n + 2 * SPAN, np.int16)
        text[words.gather(self.first, lengths)] = data.astype(np.int16) + 1
        self.text = text
        string = np.repeat(np.arange(len(lengths)), lengths + 1)
        left = self.last[string] - np.arange(n)  # bytes before the terminator
        order, rank_span = self._sorted(text[:n], left)
        before = text[np.maximum(order - 1, 0)]
        before[np.isin(order, self.first)] = 0
        head = np.ones(n, bool)
        head[1:] = before[1:] != before[:-1]
        self.heads = np.flatnonzero(head)
        self.run_at = (np.cumsum(head) - 1).astype(np.int32)
        self.symbol = before[self.heads].astype(np.int64)
        size = np.diff(np.append(self.heads, n))
        smaller = np.concatenate(([0], np.cumsum(np.bincount(text[:n], minlength=257))))
        by_symbol = np.argsort(self.symbol, kind="stable")
        seen = np.concatenate(([0], np.cumsum(size[by_symbol])))[:-1]
        counts = np.bincount(self.symbol, size, 257)
        earlier = np.concatenate(([0], np.cumsum(counts)))[:-1]
        self.target = np.empty(len(size), np.int64)  # where a run's first row goes
        self.target[by_symbol] = smaller[self.symbol[by_symbol]] + (
            seen - earlier[self.symbol[by_symbol]].astype(np.int64)
        )
        self.tails = self.heads + size - 1
        self.sample_head, self.sample_tail = order[self.heads], order[self.tails]
        # Runs of each symbol, in order.
        self.runs = self.symbol[by_symbol] * (len(size) + 1) + by_symbol
        self.run_of = by_symbol
        # Stretches of suffixes that share SPAN bytes, and their smallest document.
        same = rank_span[order]
        cut = np.ones(n, bool)
        cut[1:] = same[1:] != same[:-1]
        self.cuts = np.flatnonzero(cut)
        self.least = np.minimum.reduceat(doc[string[order]], self.cuts)

    @staticmethod
    def _sorted(text: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(suffix order, rank by the first SPAN bytes), by doubling the sorted length."""
        n = len(text)
        key = np.zeros(n + 8, np.uint64)
        for j in range(6):  # nine bits a symbol
            shifted = np.zeros(n, np.uint64)
            shifted[: n - j] = text[j:].astype(np.uint64)
            shifted[left < j] = 0
            key[:n] |= shifted << np.uint64(9 * (5 - j))
        rank, depth, spanned = _ranks(key[:n]), 6, None
        longest = int(left.max(initial=0)) + 1
        while depth < longest or spanned is None:
            if spanned is None and 2 * depth >= SPAN:
                spanned = _joined(rank, left, SPAN - depth) if depth < SPAN else rank
            if depth >= longest:
                break
            rank = _joined(rank, left, depth)
            depth *= 2
        return _in_order(rank), spanned

    def stream(self, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of indexed strings: for every place, from each string's end to
        its start, (length of the longest match, row of the transform where it is)."""
        width = int((self.last[strings] - self.first[strings]).max(initial=0))
        length = np.zeros((len(strings), width), np.int32)
        rows = np.zeros((len(strings), width), np.int64)
        at = np.zeros(len(strings), np.int64)  # a row of the transform
        matched = np.zeros(len(strings), np.int64)
        for back in range(width):
            live = np.flatnonzero(self.last[strings] - back > self.first[strings])
            place = self.last[strings[live]] - back - 1
            symbol = self.text[place].astype(np.int64)
            row, held = at[live], matched[live]
            run = self.run_at[row].astype(np.int64)
            off = np.flatnonzero(self.symbol[run] != symbol)
            if len(off):
                run[off], row[off], held[off] = self._jump(
                    run[off], symbol[off], place[off] + 1, held[off]
                )
            row = self.target[run] + row - self.heads[run]
            held = held + 1
            at[live], matched[live] = row, held
            spot = place - self.first[strings[live]]
            length[live, spot], rows[live, spot] = held, row
        return length, rows

    def _jump(self, run, symbol, place, held):
        """The nearest row before or after with the symbol, by the longer common extension."""
        key = symbol * (len(self.heads) + 1) + run
        after = np.searchsorted(self.runs, key)
        options = []
        for pick, sample, edge in (
            (after - 1, self.sample_tail, self.tails),
            (after, self.sample_head, self.heads),
        ):
            safe = np.clip(pick, 0, len(self.runs) - 1)
            other = self.run_of[safe]
            valid = (pick == safe) & (self.symbol[other] == symbol)
            reach = np.where(valid, self._extension(sample[other], place, held), -1)
            options.append((reach, other, edge[other]))
        up, down = options
        better = down[0] > up[0]
        return tuple(
            np.where(better, d, u) for d, u in ((down[1], up[1]), (down[2], up[2]), (down[0], up[0]))
        )

    def _extension(self, a, b, most):
        """Equal bytes from two places on, as far as `most` and the ends of both strings."""
        count = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        for j in range(int(most.max(initial=0))):
            live = live[j < most[live]]
            x = self.text[a[live] + j]
            live = live[(x == self.text[b[live] + j]) & (x > 0)]
            if not len(live):
                break
            count[live] += 1
        return count

    def smallest(self, rows: np.ndarray) -> np.ndarray:
        """The smallest document among the suffixes that share SPAN bytes with a row."""
        return self.least[np.searchsorted(self.cuts, rows, "right") - 1]


def _numbered(order: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    """Ranks from 1 of keys that are `sorted_` when taken in `order`; equal keys have one."""
    step = np.ones(len(order), np.int64)
    step[1:] = sorted_[1:] != sorted_[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(step)
    return rank


def _ranks(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    return _numbered(order, key[order])


def _in_order(rank: np.ndarray) -> np.ndarray:
    """Places by rank, those of one rank in order."""
    bits = np.uint64(int(len(rank)).bit_length())
    # A sort of numbers that end in their places is much faster than one of places.
    packed = np.sort(rank.astype(np.uint64) << bits | np.arange(len(rank), dtype=np.uint64))
    return (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def _joined(rank: np.ndarray, left: np.ndarray, shift: int) -> np.ndarray:
    """Ranks by what was sorted and, from `shift` on, as much again; ends sort first."""
    n = len(rank)
    second = np.zeros(n, np.int64)
    second[: n - shift] = rank[shift:]
    second[left < shift] = 0
    bits = int(n).bit_length()
    key = rank.astype(np.uint64) << np.uint64(bits) | second.astype(np.uint64)
    if 3 * bits > 64:
        return _ranks(key)
    packed = np.sort(key << np.uint64(bits) | np.arange(n, dtype=np.uint64))
    order = (packed & np.uint64((1 << bits) - 1)).astype(np.int64)
    return _numbered(order, packed >> np.uint64(bits))


def repeated(data: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each string, a mask of the places where SPAN bytes start that a smaller doc has."""
    index = RunIndex(data, ends, doc)
    mask = np.zeros(len(doc), np.int64)
    for part in np.array_split(np.arange(len(doc)), 1 + len(doc) // 20_000):
        length, rows = index.stream(part)
        line, spot = np.nonzero(length >= SPAN)
        hit = index.smallest(rows[line, spot]) < doc[part[line]]
        np.bitwise_or.at(mask, part[line[hit]], np.int64(1) << spot[hit])
    return mask


# -- jobs ------------------------------------------------------------------------------------


def _frequent(docs: DataFrame) -> np.ndarray:
    """Anchors in very many documents. A hashed sample of documents decides, but only about
    the way an anchor takes, never about what is found; at most FREQUENT times the anchors of
    a document can pass."""
    sample = docs.where(F.pmod(F.xxhash64("doc"), F.lit(SAMPLED)) == 0).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, bounds in words.blocks(batch.column(0), BLOCK):
                value, text, _, _ = anchors(data, bounds)
                pairs = np.unique(np.stack((text.astype(np.uint64), value)), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[1].view(np.int64))], names=["h"])

    least = max(8, sample.count() // FREQUENT)
    found = sample.mapInArrow(run, "h bigint").groupBy("h").count().where(F.col("count") >= least)
    return np.sort(np.array([r[0] for r in found.select("h").collect()], np.int64).view(np.uint64))


def _member(value: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(value), bool)
    at = np.minimum(np.searchsorted(sorted_, value), len(sorted_) - 1)
    return sorted_[at] == value


# Anchors travel in packed form: 40 bits below the bucket's, and 40 bits of the text's hash.
FORTY = np.uint64((1 << 40) - 1)


def _five(x: np.ndarray) -> np.ndarray:
    return (x & FORTY).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]


def _packed(rows: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(rows), 8), np.uint8)
    wide[:, :5] = rows
    return wide.view("<u8").ravel()


def _shared(docs: DataFrame, frequent, bits: int) -> DataFrame:
    """(cls, h): the mixed, cut-off hashes of anchors that two or more different texts have, by
    text."""
    shift = np.uint64(64 - bits)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value, cls = [], []
            marks = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            for first, data, bounds in words.blocks(batch.column(0), BLOCK):
                h, text, _, _ = anchors(data, bounds)
                cold = ~_member(h, frequent.value)
                # An anchor is the least of many hashes: mixed again, they fill all buckets alike.
                value.append(words.mixed(h[cold]))
                cls.append(marks[first + text[cold]])
            value, cls = np.concatenate(value), np.concatenate(cls)
            order = np.argsort(value)
            value, cls = value[order], cls[order]
            both = np.concatenate((_five(value >> np.uint64(24 - bits)), _five(cls)), axis=1)
            bucket = (value >> shift).astype(np.int64)
            names, begin = np.unique(bucket, return_index=True)
            ends = np.append(begin, len(bucket)) * 10
            blobs = pa.Array.from_buffers(
                pa.binary(), len(names),
                [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(both))],
            )
            yield pa.RecordBatch.from_arrays([pa.array(names), blobs], names=["bucket", "blob"])

    def meet(table: pa.Table) -> pa.Table:
        blob = np.frombuffer(b"".join(table["blob"].to_pylist()), np.uint8).reshape(-1, 10)
        h, cls = _packed(blob[:, :5]), _packed(blob[:, 5:])
        order = np.lexsort((cls, h))
        h, cls = h[order], cls[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (cls[1:] != cls[:-1])
        h, cls = h[fresh], cls[fresh]
        equal = h[1:] == h[:-1]
        several = np.append(equal, False) | np.append(False, equal)
        top = np.uint64(table["bucket"][0].as_py()) << np.uint64(40)
        return pa.table(
            [pa.array(cls[several].view(np.int64)), pa.array((top | h[several]).view(np.int64))],
            names=["cls", "h"],
        )

    packed = docs.select("text", "cls").mapInArrow(pack, "bucket bigint, blob binary")
    return packed.groupBy("bucket").applyInArrow(meet, "cls bigint, h bigint")


def _contexts(rows: DataFrame, frequent, bits: int) -> DataFrame:
    """A row for each occurrence of a shared anchor: h, c (hash of the context), the text's
    doc and t, its first string f, and the context's bytes."""
    keep = np.uint64(24 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, t, lists = batch.column(1), batch.column(2), batch.column(3)
            for start, data, bounds in words.blocks(batch.column(0), BLOCK):
                h, text, first, last = anchors(data, bounds)
                lists_ = lists.slice(start, len(bounds) - 1)
                wanted = lists_.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                counts = np.array([0 if x is None else x for x in pa.compute.list_value_length(lists_).to_pylist()], np.int64)
                owner = np.repeat(np.arange(len(counts)), counts)
                have = words.mixed(wanted * np.uint64(0x9E3779B97F4A7C15) + owner.astype(np.uint64))
                ask = words.mixed((words.mixed(h) >> keep) * np.uint64(0x9E3779B97F4A7C15) + text.astype(np.uint64))
                hit = np.flatnonzero(_member(ask, np.sort(have)) | _member(h, frequent.value))
                begin = bounds[text[hit]] + first[hit]
                size = last[hit] - first[hit] + SPAN
                body = data[words.gather(begin, size)]
                ends = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                at = pa.array(start + text[hit])
                columns = [
                    pa.array(h[hit].view(np.int64)),
                    pa.array(words.hashes(data, begin, begin + size).view(np.int64)),
                    doc.take(at),
                    t.take(at),
                    pa.array(first[hit]),
                    pa.Array.from_buffers(pa.binary(), len(hit), [None, pa.py_buffer(ends), pa.py_buffer(body)]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["h", "c", "doc", "t", "f", "body"])

    doc = rows.schema["doc"].dataType.simpleString()
    return rows.select("text", "doc", "t", "hs").mapInArrow(
        run, f"h bigint, c bigint, doc {doc}, t bigint, f bigint, body binary"
    )


def _digests(raw: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the SPAN bytes from each place on, made in different ways."""
    padded = np.zeros((len(begin), -(-SPAN // 8) * 8), np.uint8)
    padded[:, :SPAN] = raw[begin[:, None] + np.arange(SPAN)]
    factors = words.mixed(np.arange(1, padded.shape[1] // 8 + 1, dtype=np.uint64)) | np.uint64(1)
    other = words.mixed((words.mixed(padded.view("<u8")) * factors).sum(axis=1))
    return words.hashes(raw, begin, begin + SPAN), other


def _strings(contexts: DataFrame) -> DataFrame:
    """The strings of contexts: digests a and b, the context h and c, its doc, and the place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, STRINGS_OF):
                batch = whole.slice(at, STRINGS_OF)
                _, offsets, data = batch.column(3).buffers()
                n = batch.num_rows
                ends = np.frombuffer(offsets, np.int32, n + 1, batch.column(3).offset * 4).astype(np.int64)
                raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
                ends -= ends[0]
                count = np.diff(ends) - SPAN + 1
                row = np.repeat(np.arange(n), count)
                spot = words.gather(np.zeros(n, np.int64), count)
                a, b = _digests(raw, ends[row] + spot)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(a.view(np.int64)),
                        pa.array(b.view(np.int64)),
                        *[batch.column(i).take(take) for i in range(3)],
                        pa.array(np.int64(1) << spot),
                    ],
                    names=["a", "b", "h", "c", "doc", "mask"],
                )

    doc = contexts.schema["doc"].dataType.simpleString()
    return contexts.select("h", "c", "doc", "body").mapInArrow(
        run, f"a bigint, b bigint, h bigint, c bigint, doc {doc}, mask bigint"
    )


def _repeated_strings(crowded: DataFrame) -> DataFrame:
    """(h, c, mask) of contexts with strings that a smaller document has, string by string."""
    strings = _strings(crowded)
    lows = strings.groupBy("a", "b").agg(
        F.min("doc").alias("low"), F.max("doc").alias("high"), F.count(F.lit(1)).alias("n")
    )
    lows = store(lows.where("low < high").drop("high"), "repeat-strings")
    return (
        attach(strings, lows, ["a", "b"], "n", F.col("c"))
        .where("doc > low")
        .select("h", "c", "mask")
    )


def _indexed(table: pa.Table) -> pa.Table:
    """(h, c, mask) of the contexts of a shard that have places another, smaller doc has."""
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("mask", pa.int64())])
    if not table.num_rows:
        return schema.empty_table()
    bodies = table["body"].to_pylist()
    ends = np.concatenate(([0], np.cumsum([len(b) for b in bodies])))
    # Documents are compared by rank, so that keys of any type do.
    names = table["doc"].to_pylist()
    number = {d: i for i, d in enumerate(sorted(set(names)))}
    doc = np.array([number[d] for d in names], np.int64)
    mask = repeated(np.frombuffer(b"".join(bodies), np.uint8), ends, doc)
    out = pa.table([table["h"], table["c"], pa.array(mask)], schema=schema)
    return out.filter(pa.array(mask != 0))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes, n_removed, n_spans and kept_sha256 of every row of `docs`.

    Each byte is removed that lies in a string of SPAN bytes that also starts in a row with a
    smaller key, judged on the texts as given. NULL texts are empty, and matches never cross
    rows. Rows with a NULL key neither lose bytes nor make others lose any; rows that repeat
    a key do not count as smaller than each other.
    """
    spark = docs.sparkSession
    t, u = F.xxhash64(text), F.xxhash64(F.lit(1), text)
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"), t.alias("t"), u.alias("u"))
    able = rows.where(F.col("doc").isNotNull() & (F.octet_length("text") >= SPAN)).withColumn(
        "cls", F.shiftrightunsigned("t", 24)
    )
    size = able.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Buckets of anchors of about BUCKET rows each.
    bits = min(24, max(4, int(np.log2(max(1, size // (13 * BUCKET)))) + 1))
    frequent = spark.sparkContext.broadcast(_frequent(able))
    firsts = store(
        able.groupBy("t", "u", "cls").agg(F.min("doc").alias("low"), F.count(F.lit(1)).alias("n")),
        "repeat-texts",
    )
    lists = store(
        _shared(able, frequent, bits).groupBy("cls").agg(F.collect_list("h").alias("hs")), "repeat-anchors"
    )
    # One row of each text goes on: that with the smallest key.
    wanted = firsts.join(lists, "cls", "left").select(F.col("t").alias("_t"), "low", "hs")
    chosen = able.select("text", "doc", "t").join(
        wanted, (F.col("t") == F.col("_t")) & (F.col("doc") == F.col("low"))
    )
    places = store_dense(_contexts(chosen, frequent, bits), "repeat-contexts")
    distinct = store_dense(
        places.groupBy("h", "c").agg(
            F.min("doc").alias("doc"), F.count(F.lit(1)).alias("n"), F.first("body").alias("body")
        ),
        "repeat-distinct",
    )
    # Contexts alone under their anchor have nothing to match; many are matched by string.
    sizes = store(distinct.groupBy("h").agg(F.count(F.lit(1)).alias("same")).where("same > 1"), "repeat-sizes")
    sized = attach(distinct.drop("n"), sizes, ["h"], "same", F.col("c")).where("same > 1")
    sized = store_dense(sized, "repeat-sized")
    few = sized.where(F.col("same") <= CROWD).drop("same")
    shards = max(1, -(-few.count() // SHARD))
    deal = F.pmod(F.xxhash64("h"), F.lit(shards))
    indexed = few.withColumn("shard", deal).groupBy("shard").applyInArrow(
        _indexed, "h bigint, c bigint, mask bigint"
    )
    crowded = sized.where(F.col("same") > CROWD)
    found = indexed.unionByName(_repeated_strings(crowded)).groupBy("h", "c").agg(
        F.bit_or("mask").alias("mask")
    )
    table = store(
        distinct.join(found, ["h", "c"], "left").select(
            "h", "c", F.col("doc").alias("least"), "n", F.coalesce("mask", F.lit(0)).alias("mask")
        ),
        "repeat-found",
    )
    windows = F.expr(f"shiftleft(1L, octet_length(body) - {SPAN - 1}) - 1")
    narrow = places.select("h", "c", "doc", "t", "f", windows.alias("all"))
    marked = attach(narrow, table, ["h", "c"], "n", F.col("doc")).withColumn(
        "mask", F.when(F.col("doc") > F.col("least"), F.col("all")).otherwise(F.col("mask"))
    )
    removed = (
        marked.where("mask <> 0")
        .groupBy("t", F.col("doc").alias("low"))
        .agg(F.collect_list("f").alias("fs"), F.collect_list("mask").alias("masks"))
    )
    outcome = store(firsts.join(removed, ["t", "low"], "left").drop("cls"), "repeat-removed")
    joined = attach(rows, outcome, ["t", "u"], "n", F.col("doc")).select(
        F.col("doc").alias(key),
        "text",
        F.coalesce(F.col("doc") > F.col("low"), F.lit(False)).alias("copy"),
        F.when(F.col("doc") == F.col("low"), F.col("fs")).alias("fs"),
        F.when(F.col("doc") == F.col("low"), F.col("masks")).alias("masks"),
    )
    return with_results(joined, ["text", "copy", "fs", "masks"], _cut, RESULT, [key])


RESULT = pa.schema(
    [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
)


def _cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Take the marked bytes out of each text."""
    copy = batch.column(1).to_pylist()
    for first, data, bounds in words.blocks(batch.column(0), BLOCK):
        made = []
        for i in range(len(bounds) - 1):
            raw = data[bounds[i] : bounds[i + 1]]
            starts = batch.column(2)[first + i].values
            gone = np.zeros(len(raw), bool)
            if copy[first + i]:
                gone[:] = len(raw) >= SPAN
            elif starts is not None and len(starts):
                masks = np.array(batch.column(3)[first + i].values, np.int64)
                bit = (masks[:, None] >> np.arange(WINDOWS)) & 1
                at = (np.array(starts, np.int64)[:, None] + np.arange(WINDOWS))[bit == 1]
                step = np.zeros(len(raw) + 1, np.int64)
                np.add.at(step, at, 1)
                np.add.at(step, at + SPAN, -1)
                gone = np.cumsum(step[:-1]) > 0
            spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            kept = hashlib.sha256(raw[~gone].tobytes() if spans else memoryview(raw)).hexdigest()
            made.append((len(raw), int(gone.sum()), spans, kept))
        columns = [pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), RESULT, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, schema=RESULT)
