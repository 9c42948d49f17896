"""Byte-pair encoding and decoding with a contiguous rank array.

A word of up to SHORT symbols is a row of part ids and a row of the ranks of
adjacent parts. Again and again the smallest rank is looked for, the boundary there
is deleted, and the ranks on either side are looked up anew; all words of one
length take each step together. Longer words keep their parts in a linked list with
a heap of ranks, which gives the same merges.

Normalising and cutting into pre-tokens follow the tokenizer file. A run of non-white
bytes never depends on its neighbours, so every distinct piece of a block is encoded
once. Runs of ASCII and Latin-1 letters, digits and signs are cut as bytes; all others
go through the library's own normaliser and splitter.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from offerwise.llm import words
from offerwise.llm.columns import with_results

SHORT = 48
REMEMBERED = 500_000
NONE = np.int32(np.iinfo(np.int32).max)
VOCABULARY = "word_bpe_49k.json"


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Encoder:
    """The vocabulary and merges of a tokenizer file, as lookup arrays."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        characters = _byte_characters()
        self.inner = np.array([vocab[c] for c in characters], np.int32)
        self.final = np.array([vocab[c + suffix] for c in characters], np.int32)
        self.byte_of = {c: b for b, c in enumerate(characters)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile("|".join(map(re.escape, self.special)))
        tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.tokens = [tokens[i] for i in range(len(tokens))]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        left = np.array([vocab[a] for a, _ in pairs], np.uint64)
        right = np.array([vocab[b] for _, b in pairs], np.uint64)
        self._index(left << np.uint64(32) | right)
        self.known = (pa.array([], pa.binary()), np.zeros(0, np.int32), np.zeros(0, np.int64))

    def _index(self, keys: np.ndarray) -> None:
        """An open-addressing table from pairs to ranks, filled probe by probe."""
        self.bits = max(10, int(len(keys)).bit_length() + 2)
        self.keys = np.full(1 << self.bits, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        slots, waiting = self._slot(keys), np.arange(len(keys))
        while len(waiting):
            free = self.ranks[slots[waiting]] == NONE
            _, first = np.unique(slots[waiting[free]], return_index=True)
            placed = waiting[free][first]
            self.keys[slots[placed]], self.ranks[slots[placed]] = keys[placed], placed
            waiting = np.setdiff1d(waiting, placed, assume_unique=True)
            taken = waiting[self.ranks[slots[waiting]] != NONE]
            slots[taken] = (slots[taken] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        product = keys * np.uint64(0x9E3779B97F4A7C15)
        return (product >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of parts, NONE where no merge exists."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slots = self._slot(keys)
        found = np.where(self.keys[slots] == keys, self.ranks[slots], NONE)
        again = np.flatnonzero((found == NONE) & (self.ranks[slots] != NONE))
        while len(again):
            slots[again] = (slots[again] + 1) & (len(self.keys) - 1)
            hit = self.keys[slots[again]] == keys[again]
            found[again[hit]] = self.ranks[slots[again[hit]]]
            again = again[~hit & (self.ranks[slots[again]] != NONE)]
        return found

    def merge_rows(self, parts: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Encode equally long words; returns row numbers and their final parts."""
        rows, where, final = np.arange(len(parts)), [], []
        ranks = (
            self.rank(parts[:, :-1].ravel(), parts[:, 1:].ravel()).reshape(len(parts), -1)
            if parts.shape[1] > 1
            else np.zeros((len(parts), 0), np.int32)
        )
        while len(rows):
            width = parts.shape[1]
            if width == 1:
                where.append(rows)
                final.append(parts)
                break
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            if (done := best == NONE).any():
                where.append(rows[done])
                final.append(parts[done])
                live = ~done
                rows, parts, ranks, at, best = (x[live] for x in (rows, parts, ranks, at, best))
                if not len(rows):
                    break
            line = np.arange(len(rows))
            parts[line, at] = self.made[best]
            column = np.arange(width - 1)
            parts = np.take_along_axis(parts, column + (column > at[:, None]), axis=1)
            column = column[:-1]
            ranks = np.take_along_axis(ranks, column + (column >= at[:, None]), axis=1)
            for left in (at - 1, at):
                fresh = np.flatnonzero((left >= 0) & (left < width - 2))
                i = left[fresh]
                ranks[fresh, i] = self.rank(parts[fresh, i], parts[fresh, i + 1])
        return where, final

    def merge_long(self, parts: np.ndarray) -> np.ndarray:
        """Encode one word of any length: the merges of `merge_rows` from a heap."""
        n = len(parts)
        ids, after, before = parts.tolist(), [*range(1, n), -1], [*range(-1, n - 1)]
        first = self.rank(parts[:-1], parts[1:])
        heap = [(r, i) for i, r in enumerate(first.tolist()) if r != NONE]
        heapq.heapify(heap)
        current = first.tolist() + [int(NONE)]

        def refresh(i: int) -> None:
            j = after[i]
            rank = int(NONE)
            if j >= 0:
                rank = int(self.rank(np.array([ids[i]]), np.array([ids[j]]))[0])
            current[i] = rank
            if rank != NONE:
                heapq.heappush(heap, (rank, i))

        while heap:
            rank, i = heapq.heappop(heap)
            if current[i] != rank:
                continue
            j = after[i]
            ids[i], after[i], current[j] = int(self.made[rank]), after[j], int(NONE)
            if after[j] >= 0:
                before[after[j]] = i
            refresh(i)
            if before[i] >= 0:
                refresh(before[i])
        out, i = [], 0
        while i >= 0:
            out.append(ids[i])
            i = after[i]
        return np.array(out, np.int32)

    def merge(self, parts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encode words given as joined symbol ids; returns joined tokens and counts."""
        starts = np.concatenate(([0], np.cumsum(counts)))[:-1]
        sizes = np.zeros(len(counts), np.int64)
        got: list[tuple[np.ndarray, np.ndarray]] = []
        for size in np.unique(counts[counts > 0]):
            chosen = np.flatnonzero(counts == size)
            if size > SHORT:
                for i in chosen:
                    tokens = self.merge_long(parts[starts[i] : starts[i] + size])
                    got.append((np.array([i]), tokens[None, :]))
                continue
            for part in np.array_split(chosen, 1 + len(chosen) // 50_000):
                where, final = self.merge_rows(parts[starts[part][:, None] + np.arange(size)])
                got += [(part[w], f) for w, f in zip(where, final, strict=True)]
        for where, final in got:
            sizes[where] = final.shape[1]
        begins = np.concatenate(([0], np.cumsum(sizes)))
        out = np.zeros(begins[-1], np.int32)
        for where, final in got:
            out[begins[where][:, None] + np.arange(final.shape[1])] = final
        return out, sizes

    def words(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of distinct pieces or whole runs: joined ids, and how many each."""
        n = len(distinct)
        _, offsets, data = distinct.buffers()
        ends = np.frombuffer(offsets, np.int32, n + 1, distinct.offset * 4).astype(np.int64)
        raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if n else np.zeros(0, np.uint8)
        ends = ends - ends[0]
        low, kind = _plain(raw)
        bad = np.concatenate(([0], np.cumsum(kind == OTHER)))
        slow = np.flatnonzero(bad[ends[1:]] > bad[ends[:-1]])
        symbols = self.inner[low]
        if n:
            symbols[ends[1:] - 1] = self.final[low[ends[1:] - 1]]
        counts = np.diff(ends)
        counts[slow] = 0
        keep = np.ones(len(raw), bool)
        pieces, piece_counts, of, fixed = [], [], [], []
        for i in slow:
            keep[ends[i] : ends[i + 1]] = False
            for ids, merged in self._cut(raw[ends[i] : ends[i + 1]].tobytes().decode("utf-8")):
                pieces.append(ids)
                piece_counts.append(len(ids))
                of.append(i)
                fixed.append(merged)
        tokens, sizes = self.merge(symbols[keep], counts)
        if not pieces:
            return tokens, sizes
        # Slow words: encode their pieces, then put each behind the one before.
        more, more_sizes = self.merge(
            np.concatenate([p for p, f in zip(pieces, fixed, strict=True) if not f] or [symbols[:0]]),
            np.array([c for c, f in zip(piece_counts, fixed, strict=True) if not f], np.int64),
        )
        bounds = np.concatenate(([0], np.cumsum(more_sizes)))
        extra: dict[int, list[np.ndarray]] = {}
        at = 0
        for ids, i, merged in zip(pieces, of, fixed, strict=True):
            if not merged:
                ids, at = more[bounds[at] : bounds[at + 1]], at + 1
            extra.setdefault(int(i), []).append(ids)
        joined = {i: np.concatenate(p) for i, p in extra.items()}
        total = sizes.copy()
        for i, ids in joined.items():
            total[i] = len(ids)
        begins = np.concatenate(([0], np.cumsum(total)))
        out = np.zeros(begins[-1], np.int32)
        fast = np.flatnonzero(sizes)
        out[words.gather(begins[fast], sizes[fast])] = tokens
        for i, ids in joined.items():
            out[begins[i] : begins[i] + len(ids)] = ids
        return out, total

    def remembered(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """`words`, and the place of each among them; the first REMEMBERED are kept encoded."""
        known, tokens, sizes = self.known
        place = pc.fill_null(pc.index_in(distinct, known), -1).to_numpy()
        fresh = np.flatnonzero(place < 0)
        new = distinct.take(pa.array(fresh))
        more, more_sizes = self.words(new)
        place = place.astype(np.int64)
        place[fresh] = len(known) + np.arange(len(fresh))
        tokens, sizes = np.concatenate((tokens, more)), np.concatenate((sizes, more_sizes))
        if len(sizes) <= REMEMBERED and len(tokens) <= 8 * REMEMBERED:
            self.known = (pa.concat_arrays([known, new]), tokens, sizes)
        return tokens, sizes, place

    def _cut(self, text: str) -> Iterator[tuple[np.ndarray, bool]]:
        """Symbol ids of the pre-tokens of a run, and ids of special tokens (True)."""
        at = 0
        for match in [*self.special_pattern.finditer(text), None]:
            plain = text[at : match.start() if match else len(text)]
            normal = self.library.normalizer.normalize_str(plain)
            for token, _ in self.library.pre_tokenizer.pre_tokenize_str(normal):
                piece = np.array([self.byte_of[c] for c in token], np.int64)
                symbols = self.inner[piece]
                symbols[-1:] = self.final[piece[-1:]]
                yield symbols, False
            if match:
                yield np.array([self.special[match.group()]], np.int32), True
                at = match.end()

    @property
    def decimals(self) -> pa.Array:
        """For each id: a space and the id in decimals."""
        if not hasattr(self, "_decimals"):
            self._decimals = pa.array([f" {i}" for i in range(len(self.tokens))], pa.large_string())
        return self._decimals

    @property
    def spaced(self) -> pa.Array:
        """For each id: a space and the token. The file names no decoder: tokens are spaced."""
        if not hasattr(self, "_spaced"):
            self._spaced = pa.array([f" {t}" for t in self.tokens], pa.large_string())
        return self._spaced


# Classes of bytes whose cut into pre-tokens is known: letters of ASCII and Latin-1,
# digits one by one, runs of signs. An apostrophe may begin an ending like 's and "<" a
# special token, so runs that hold those go to the library, as does all other text.
OTHER, SPACE, LETTER, DIGIT, SIGN, RUN = range(6)
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[0x21:0x7F] = SIGN
_CLASS[[ord("'"), ord("<")]] = OTHER
_CLASS[ord("0") : ord("9") + 1] = DIGIT
_CLASS[ord("A") : ord("Z") + 1] = LETTER
_CLASS[ord("a") : ord("z") + 1] = LETTER
_CLASS[list(words.WHITE)] = SPACE


def _plain(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes, and the class of each."""
    low, kind = words.lowered(raw), _CLASS[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3) if len(raw) else np.zeros(0, np.int64)
    tail = raw[lead + 1]
    letter = (tail != 0x97) & (tail != 0xB7)  # the signs for multiplication and division
    kind[lead[letter]] = kind[lead[letter] + 1] = LETTER
    upper = lead[letter & (tail <= 0x9E)] + 1
    low[upper] += 0x20
    return low, kind


def _pieces(data: np.ndarray, bounds: np.ndarray):
    """(starts, ends, pieces before each text): pre-tokens, and whole runs for the library."""
    _, kind = _plain(data)
    starts, ends, _ = words.spans(data, bounds)
    bad = np.concatenate(([0], np.cumsum(kind == OTHER)))
    slow = bad[ends] > bad[starts]
    step = np.zeros(len(data) + 1, np.int8)
    step[starts[slow]] += 1
    step[ends[slow]] -= 1
    kind[np.cumsum(step[:-1], dtype=np.int8) > 0] = RUN
    cut = np.ones(len(data) + 1, bool)
    cut[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    cut[bounds] = True
    cut[starts] = True
    edges = np.flatnonzero(cut)
    inner = kind[edges[:-1]] != SPACE
    begins = edges[:-1][inner]
    return begins, edges[1:][inner], np.searchsorted(begins, bounds)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_block(tool: Encoder, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts of a block, joined, and the bounds of each text's ids."""
    starts, ends, before = _pieces(data, bounds) if len(data) else words.spans(data, bounds)
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
    step = np.zeros(len(data) + 1, np.int8)
    step[starts] += 1
    step[ends] -= 1
    body = data[np.cumsum(step[:-1], dtype=np.int8) > 0]
    runs = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)]
    ).dictionary_encode()
    tokens, sizes, place = tool.remembered(runs.dictionary)
    codes = place[runs.indices.to_numpy()]
    begins = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    each = sizes[codes]
    total = np.concatenate(([0], np.cumsum(each)))
    return tokens[words.gather(begins[codes], each)], total[before]


def decode(tool: Encoder, ids: np.ndarray, bounds: np.ndarray, table: pa.Array) -> Iterator[memoryview]:
    """For each text, the entries of `table` for its ids, joined, without the first space."""
    joined = table.take(pa.array(ids, pa.int32()))
    _, offsets, data = joined.buffers()
    ends = np.frombuffer(offsets, np.int64, len(ids) + 1, joined.offset * 8)
    view = memoryview(data) if data is not None else memoryview(b"")
    for a, b in zip(ends[bounds[:-1]].tolist(), ends[bounds[1:]].tolist(), strict=True):
        yield view[a + 1 : b] if b > a else view[:0]


RESULTS = {
    "digests": pa.schema(
        [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    ),
    "texts": pa.schema([("ids", pa.list_(pa.int32())), ("decoded", pa.string())]),
}


def encode_decode(
    docs: DataFrame, path: str | None = None, text: str = "text", out: str = "digests"
) -> DataFrame:
    """Encode each text and decode its ids; one row per row of `docs`, in one narrow stage.

    out="digests" adds n_tokens, ids_sha256 and decoded_sha256; out="texts" adds ids and
    decoded. NULL and empty texts have no ids and decode to the empty text. Repeated rows
    are encoded each; columns of `docs` named like a result give way to it.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def results(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for _, data, bounds in words.blocks(batch.column(0)):
            ids, ends = encode_block(tool, data, bounds)
            spelled = decode(tool, ids, ends, tool.spaced)
            if out == "texts":
                listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
                decoded = pa.array([str(t, "utf-8") for t in spelled], pa.string())
                yield pa.RecordBatch.from_arrays([listed, decoded], schema=RESULTS[out])
                continue
            numbers = decode(tool, ids, ends, tool.decimals)
            columns = [
                pa.array(np.diff(ends), pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in numbers], pa.string()),
                pa.array([hashlib.sha256(t).hexdigest() for t in spelled], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=RESULTS[out])

    return with_results(docs, [text], results, RESULTS[out])
