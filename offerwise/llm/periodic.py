"""Runs of repeated word sequences, by an online sparse diagonal recurrence.

A run is a stretch of consecutive words with a smallest period q that no neighbouring word
extends; it counts if it has at least max(LEAST_WORDS, LEAST_TURNS * q) words. Seen as a
table of (word, lag), the cell (i, q) holds how many words up to i equal the words q before
them, one more than the cell (i - 1, q) if word i equals word i - q. A run of period q is a
diagonal q that ends (word and earlier word differ, or the text is over) after at least
three periods of matches, and is given out there.

The table is sparse. A word's earlier occurrences make cells of their lags active, but a lag
q can only grow long enough if whole stretches of words match, and two such lags cannot be
active at once: for the width m with m / 2 < q <= m, the nearest earlier occurrence of the m
words that end in a word lies exactly q before, all along the run, but for its first q + m - 1
words (else the stretch would have two periods, and by the theorem of Fine and Wilf a smaller
one). So every width, 5, 10, 20 and so on, has one active lag a word, the one of that nearest
occurrence; a lag that stays the same adds one to its match length, a change of lag ends it.
Only words whose stretch of m / 2 words occurs twice in the text reach the next width. That
takes time in proportion to the words and the logarithm of their number, with any repetition.

Words are told apart by 64-bit hashes; the words of each run found are compared again, byte by
byte, before it counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerwise.llm.columns import with_results
from offerwise.llm.words import blocks, gather, hashes, mixed, spans

LEAST_WORDS = 6
LEAST_TURNS = 4

# Periods up to this are found at the first width; each further width doubles it.
NARROW = 5

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RESULT = pa.schema([("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of sequences, from those of their two parts."""
    return mixed(a * _STEP + b)


def _nearest(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position of the ascending `at`: words back to the nearest earlier position with
    the same key (0: none), and whether the key occurs at another position at all."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(at) + 1, bool)
    same[1:-1] = keys[order[1:]] == keys[order[:-1]]
    lag, twice = np.zeros(len(at), np.int64), np.empty(len(at), bool)
    places = at[order]
    back = np.concatenate(([0], places[1:] - places[:-1])) if len(at) else places
    lag[order] = np.where(same[:-1], back, 0)
    twice[order] = same[:-1] | same[1:]
    return lag, twice


def _ended(at: np.ndarray, lag: np.ndarray, width: int, least: int) -> np.ndarray:
    """(start, length, period) of each diagonal that matched long enough at this width.

    `at` are the words, in order, whose nearest earlier stretch of `width` words is `lag` back.
    """
    if not len(at):
        return np.zeros((0, 3), np.int64)
    goes_on = (at[1:] == at[:-1] + 1) & (lag[1:] == lag[:-1])
    first = np.flatnonzero(np.concatenate(([True], ~goes_on)))
    last = np.concatenate((first[1:], [len(at)])) - 1
    # The first match of the stretch began `width` - 1 words before, its model `lag` before that.
    period = lag[first]
    start = at[first] - (width - 1) - period
    length = at[last] + 1 - start
    long = (period > least) & (period <= width) & (
        length >= np.maximum(LEAST_WORDS, LEAST_TURNS * period)
    )
    return np.stack([start[long], length[long], period[long]], 1)


def runs_of(keys: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """(start, length, period) of all runs, by start and period, in a sequence of word hashes;
    `texts` is the number of each word's text, ascending. No run crosses texts."""
    n = len(keys)
    if n < LEAST_WORDS:
        return np.zeros((0, 3), np.int64)
    keys = mixed(keys ^ (texts.astype(np.uint64) * _STEP))
    begins = np.searchsorted(texts, texts)
    held = np.zeros(n, np.uint64)

    two = _joined(keys[1:], keys[:-1])
    four = _joined(two[2:], two[:-2])
    five = _joined(four[1:], keys[: n - 4])
    at = np.arange(4, n)
    inside = at - begins[4:] >= 4
    at, stretch = at[inside], five[inside]
    width, least, found = NARROW, 0, []
    while len(at):
        lag, twice = _nearest(stretch, at)
        some = lag > 0
        found.append(_ended(at[some], lag[some], width, least))
        # Twice as wide: both halves must occur twice.
        at, stretch = at[twice], stretch[twice]
        held[at] = stretch
        here = np.zeros(n, bool)
        here[at] = True
        wide = (at - begins[at] >= 2 * width - 1) & here[np.maximum(at - width, 0)]
        stretch = _joined(stretch[wide], held[at[wide] - width])
        at = at[wide]
        least, width = width, 2 * width
    all_runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return all_runs[np.lexsort((all_runs[:, 2], all_runs[:, 0]))]


def _same_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, run: np.ndarray) -> bool:
    """Whether the words of a run equal, byte by byte, those one period before."""
    start, length, period = run
    a = slice(start, start + length - period)
    b = slice(start + period, start + length)
    sizes = ends[a] - starts[a]
    if not (sizes == ends[b] - starts[b]).all():
        return False
    return bool((data[gather(starts[a], sizes)] == data[gather(starts[b], sizes)]).all())


def _planted(order: np.ndarray, before: np.ndarray, seeds: list[int | None]) -> np.ndarray:
    """Numbers of the words to read, with the tails of some texts made periodic (see `with_runs`)."""
    for i, seed in enumerate(seeds):
        first, n = before[i], before[i + 1] - before[i]
        if seed is None or seed % 10 or not n:
            continue
        g = seed // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        order[first + a : first + n] = first + a + np.arange(n - a) % p
    return order


def _collapsed(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, texts: np.ndarray, n_texts: int
) -> pa.Array:
    """Texts of the given words, each text's joined by one space."""
    sizes = ends - starts + 1
    # A text's last word is followed by nothing.
    last = np.ones(len(texts), bool)
    last[:-1] = texts[1:] != texts[:-1]
    sizes = sizes - last
    out = np.full(int(sizes.sum()) + 1, 0x20, np.uint8)
    to = np.concatenate(([0], np.cumsum(sizes)))
    letters = ends - starts
    out[gather(to[:-1], letters)] = data[gather(starts, letters)]
    bounds = to[np.searchsorted(texts, np.arange(n_texts + 1))]
    buffers = [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out[:-1])]
    return pa.Array.from_buffers(pa.large_string(), n_texts, buffers).cast(pa.string())


def _results(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    seeds = batch.column(1).to_pylist()
    for first, data, bounds in blocks(batch.column(0)):
        n_texts = len(bounds) - 1
        starts, ends, before = spans(data, bounds)
        texts = np.repeat(np.arange(n_texts), np.diff(before))
        order = _planted(np.arange(len(starts)), before, seeds[first : first + n_texts])
        keys = hashes(data, starts, ends)[order]
        starts, ends = starts[order], ends[order]
        runs = runs_of(keys, texts)
        true = [_same_words(data, starts, ends, run) for run in runs]
        runs = runs[np.array(true, bool)]
        # Words that some run has after its first period.
        depth = np.zeros(len(keys) + 1, np.int64)
        np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
        np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
        kept = np.cumsum(depth)[:-1] == 0
        # Runs are ordered by start, so those of a text lie together.
        at = np.searchsorted(runs[:, 0], before)
        own = texts[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
        columns = [runs[:, 0] - before[own], runs[:, 1], runs[:, 2]]
        structs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(_RUN))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.diff(before), pa.int64()),
                pa.ListArray.from_arrays(pa.array(at, pa.int32()), structs).cast(RESULT.field("runs").type),
                _collapsed(data, starts[kept], ends[kept], texts[kept], n_texts),
            ],
            schema=RESULT,
        )


def with_runs(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, seed: Column | None = None
) -> DataFrame:
    """`docs` (or its columns `keep`) with n_words, runs and collapsed of each whole text.

    Words are what ASCII white space separates. `runs` lists (start, length, period) by start,
    then period, words numbered from 0; `collapsed` is the text without the words that some run
    has after its first period, the others joined by one space. Columns of `docs` that are
    called like these are replaced. NULL, empty and blank texts have no words, no runs and an
    empty `collapsed`. Very long texts are a block of their own. Ties cannot occur: no two runs
    have the same start and period. Repeated rows have equal results; an empty table gives none.

    `seed`, a long, plants periodicity to check against: with seed % 10 = 0, g = seed / 10 and n
    words, word i >= a = g % n is read as word a + (i - a) % p, p = 1 + (n - a) / (3 + g % 8).
    A NULL seed changes nothing.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in RESULT.names]
    given = F.lit(None).cast("bigint") if seed is None else seed.cast("bigint")
    rows = docs.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)],
        F.col(f"`{text}`").alias("text"),
        given.alias("seed"),
    )
    found = with_results(rows, ["text", "seed"], _results, RESULT, [f"c{i}" for i in range(len(kept))])
    return found.withColumnsRenamed({f"c{i}": c for i, c in enumerate(kept)})


def digests(found: DataFrame) -> DataFrame:
    """`with_runs` rows with n_runs, the longest run's start, length, period and exponent_milli
    (NULL without runs; ties: smallest start, then period) and both texts' digests."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    # Of equal lengths the first stays: runs ascend by start, then period.
    best = F.expr(
        "aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>),"
        " (best, r) -> if(best is null or r.length > best.length, r, best))"
    )
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    kept = [c for c in found.columns if c not in RESULT.names]
    return found.withColumn("_best", best).select(
        *kept,
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
