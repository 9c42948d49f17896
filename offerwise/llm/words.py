"""Words of a column of texts as NumPy arrays over its UTF-8 bytes.

Inside a task a batch of texts is cut into blocks of whole texts, so that working
memory follows BLOCK_BYTES (or one text, if that is longer) and not the batch.
A block is its bytes and the texts' bounds; words are pairs of byte positions.
NULL texts are empty texts here.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20

# ASCII white space as the contracts list it.
WHITE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_NOT_WHITE = np.ones(256, bool)
_NOT_WHITE[list(WHITE)] = False

# Letters of any script: ASCII letters and every byte of a multi-byte character.
_LETTER = np.zeros(256, bool)
_LETTER[ord("A") : ord("Z") + 1] = True
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, bytes, bounds) of runs of whole texts."""
    if pa.types.is_null(texts.type):
        texts = texts.cast(pa.string())
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    n = len(texts)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(ends, ends[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, raw[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z, and only those, in lower case."""
    return _LOWER[data]


def spans(data: np.ndarray, bounds: np.ndarray, letters: bool = False):
    """(starts, ends, words before each text): runs of non-white bytes, or of letters."""
    inside = (_LETTER if letters else _NOT_WHITE)[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(bounds), np.int64)
    # A text's edge ends a word.
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    begin = inside & edge[:-1]
    begin[1:] |= inside[1:] & ~inside[:-1]
    finish = inside & edge[1:]
    finish[:-1] |= inside[:-1] & ~inside[1:]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(finish) + 1, np.searchsorted(starts, bounds)


def letters_before(data: np.ndarray) -> np.ndarray:
    """ASCII letters before each position, and in all."""
    low = _LOWER[data]
    return np.concatenate(([0], np.cumsum((low >= ord("a")) & (low <= ord("z")))))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        factors = np.full(n, base, np.uint64)
        factors[0] = 1
        out.append(np.multiply.accumulate(factors))
    return out[0], out[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same for equal spans anywhere."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = 1 << max((BLOCK_BYTES - 1).bit_length(), int(len(data)).bit_length())
    power, inverse = _powers(size)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=total[1:])
    return mixed((total[ends] - total[starts]) * inverse[starts])


def gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions starts[i], starts[i]+1, ... of counts[i] entries for each i, joined."""
    total = int(counts.sum())
    shift = starts - np.concatenate(([0], np.cumsum(counts)[:-1])) if len(counts) else starts
    return np.repeat(shift, counts) + np.arange(total)
