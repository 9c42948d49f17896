"""Languages of words by a linear-chain conditional random field.

A word's features are hashed: the whole word (lexicon), its first and last 1 to 4 bytes
(affixes) and all runs of 3 bytes inside it with its edges marked. Feature weights and label
transitions are learned together by gradient ascent on the likelihood of labelled texts.
Forward-backward gives each word's label probabilities; a text's language is the label with
the largest mean over its words, so that texts that switch languages get one too.

Sequences are cut into segments whose transfer matrices are multiplied, so that NumPy works
on all segments of a block at once; the result is that of the plain recursion.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwise.llm import words
from offerwise.llm.columns import with_results

BUCKETS = 1 << 17
SEGMENT = 32
UNKNOWN = "und"


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # bucket x label
    transitions: np.ndarray  # log scores, from x to
    start: np.ndarray


def features(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, word of each) of all features of distinct words."""
    n = len(distinct)
    _, offsets, data = distinct.buffers()
    ends = np.frombuffer(offsets, np.int32, n + 1, distinct.offset * 4).astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    starts, ends = ends[:-1] - ends[0], ends[1:] - ends[0]
    number = np.arange(n)
    found = [words.hashes(raw, starts, ends)]
    of = [number]

    def add(kind: int, begin: np.ndarray, stop: np.ndarray, word: np.ndarray) -> None:
        salt = words.mixed(np.array([kind], np.uint64))
        found.append(words.hashes(raw, begin, stop) ^ salt)
        of.append(word)

    for size in (1, 2, 3, 4):
        fit = np.flatnonzero(ends - starts >= size)
        add(size, starts[fit], starts[fit] + size, fit)
        add(16 + size, ends[fit] - size, ends[fit], fit)
    inner = np.maximum(ends - starts - 2, 0)
    begin = words.gather(starts, inner)
    add(32, begin, begin + 3, np.repeat(number, inner))
    buckets = (np.concatenate(found) & np.uint64(BUCKETS - 1)).astype(np.int64)
    return buckets, np.concatenate(of)


def summed(rows: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Rows added up at the places `at`."""
    return np.stack([np.bincount(at, rows[:, j], n) for j in range(rows.shape[1])], axis=1)


def lexicon(data: np.ndarray, bounds: np.ndarray):
    """(distinct words, code of each word, words before each text)."""
    data = words.lowered(data)
    starts, ends, before = words.spans(data, bounds, letters=True)
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
    body = data[words.gather(starts, ends - starts)]
    coded = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)]
    ).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), before


def messages(emit: np.ndarray, bounds: np.ndarray, step: np.ndarray, start: np.ndarray) -> np.ndarray:
    """x[t] = emit[t] * (x[t-1] @ step), scaled, with x[0] = emit[0] * start, in each sequence."""
    n, width = emit.shape
    lengths = np.diff(bounds)
    pieces = -(-lengths // SEGMENT)
    total = int(pieces.sum())
    if not total:
        return emit
    first = np.concatenate(([0], np.cumsum(pieces)))[:-1]
    begin = np.repeat(bounds[:-1] - first * SEGMENT, pieces) + np.arange(total) * SEGMENT
    stop = np.repeat(bounds[1:], pieces)
    index = np.minimum(begin[:, None] + np.arange(SEGMENT), n - 1)
    inside = emit[index]
    # Transfer matrix of each segment: from what enters it to what leaves it.
    through = np.eye(width) * inside[:, 0, None, :]
    for t in range(1, SEGMENT):
        through = (through.reshape(-1, width) @ step).reshape(-1, width, width) * inside[:, t, None, :]
        if t % 8 == 0:
            through /= np.maximum(through.max(axis=(1, 2), keepdims=True), 1e-300)
    enter = np.zeros((total, width))
    at, live = first[pieces > 0], pieces[pieces > 0]
    enter[at] = start
    for j in range(1, int(pieces.max())):
        at, live = at[live > j], live[live > j]
        left = np.einsum("si,sij->sj", enter[at + j - 1], through[at + j - 1])
        left /= np.maximum(left.sum(axis=1, keepdims=True), 1e-300)
        enter[at + j] = left @ step
    out = np.empty_like(inside)
    x = enter
    for t in range(SEGMENT):
        x = (x @ step if t else x) * inside[:, t]
        x = x / np.maximum(x.sum(axis=1, keepdims=True), 1e-300)
        out[:, t] = x
    return out[begin[:, None] + np.arange(SEGMENT) < stop[:, None]]


def marginals(scores: np.ndarray, bounds: np.ndarray, model: Model):
    """(label probabilities of each word, forward, backward with emission, exp transitions)."""
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    emit = np.maximum(emit, 1e-30)
    step = np.exp(model.transitions - model.transitions.max())
    forward = messages(emit, bounds, step, np.exp(model.start - model.start.max()))
    # Backward is forward over reversed sequences with transposed transitions.
    turned = bounds[-1] - bounds[::-1]
    backward = messages(emit[::-1], turned, step.T, np.ones(emit.shape[1]))[::-1]
    gamma = forward * backward / emit
    gamma /= gamma.sum(axis=1, keepdims=True)
    return gamma, forward, backward, step


def train(
    texts: pa.Array, langs: np.ndarray, labels: list[str], rounds: int = 30, rate: float = 0.5
) -> Model:
    """Learn from whole texts that are each in one language (`langs`: label numbers)."""
    width = len(labels)
    blocks = []
    for first, data, bounds in words.blocks(texts):
        distinct, codes, before = lexicon(data, bounds)
        buckets, of = features(distinct) if len(distinct) else (np.zeros(0, np.int64),) * 2
        truth = np.repeat(langs[first : first + len(bounds) - 1], np.diff(before))
        blocks.append((len(distinct), codes, before, buckets, of, truth))
    model = Model(labels, np.zeros((BUCKETS, width)), np.zeros((width, width)), np.zeros(width))
    scale_w, scale_t = np.full((BUCKETS, width), 1e-6), np.full((width, width), 1e-6)
    count = max(1, sum(len(b[1]) for b in blocks))
    for _ in range(rounds):
        slope_w, slope_t = -1e-6 * model.weights, -1e-6 * model.transitions
        for n, codes, before, buckets, of, truth in blocks:
            if not len(codes):
                continue
            scores = summed(model.weights[buckets], of, n)[codes]
            gamma, forward, backward, step = marginals(scores, before, model)
            miss = -gamma
            miss[np.arange(len(truth)), truth] += 1
            slope_w += summed(summed(miss, codes, n)[of], buckets, BUCKETS) / count
            inner = np.ones(len(codes), bool)
            inner[before[:-1][before[:-1] < len(codes)]] = False
            at = np.flatnonzero(inner)
            pairs = np.einsum("ni,ij,nj->n", forward[at - 1], step, backward[at])
            expected = step * ((forward[at - 1] / pairs[:, None]).T @ backward[at])
            seen = np.bincount(truth[at - 1] * width + truth[at], minlength=width * width)
            slope_t += (seen.reshape(width, width) - expected) / count
        scale_w += slope_w * slope_w
        scale_t += slope_t * slope_t
        model.weights += rate * slope_w / np.sqrt(scale_w)
        model.transitions += rate * slope_t / np.sqrt(scale_t)
    return model


def fit(docs: DataFrame, learn, key: str = "doc_id", text: str = "text", lang: str = "lang",
        examples: int = 1_200, rounds: int = 30) -> Model:
    """Learn from rows of `docs` where the condition `learn` and a language are given.

    At most `examples` whole texts, those with the smallest hashed keys of each language in
    equal shares, are brought together for the fit; that bound holds at any size. The
    languages themselves are counted over all rows.
    """
    rows = docs.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
    labels = sorted(r[0] for r in rows.groupBy(lang).count().select(lang).collect())
    order = [F.xxhash64(key), F.col(key)]
    each = max(1, examples // max(1, len(labels)))
    sample = None
    for name in labels:
        part = rows.where(F.col(lang) == name).select(key, lang).orderBy(*order).limit(each)
        sample = part if sample is None else sample.unionByName(part)
    if sample is None:
        return Model([UNKNOWN], np.zeros((BUCKETS, 1)), np.zeros((1, 1)), np.zeros(1))
    chosen = rows.join(F.broadcast(sample.select(key).distinct()), key, "left_semi")
    table = chosen.select(key, lang, text).orderBy(key, lang, F.xxhash64(text)).toArrow()
    number = {name: i for i, name in enumerate(labels)}
    langs = np.array([number[x] for x in table[lang].to_pylist()], np.int64)
    return train(table[text].combine_chunks(), langs, labels, rounds)


RESULT = pa.schema([("lang_pred", pa.string()), ("score", pa.float64())])


def labelled(docs: DataFrame, model: Model, text: str = "text", keep=None) -> DataFrame:
    """`docs` with lang_pred and score, the mean probability of that label over the words.

    Texts that are NULL or without a letter get `und` and 0.0. Ties go to the label that comes
    first. The model is sent to every task; its size is set by BUCKETS and the languages.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def results(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for _, data, bounds in words.blocks(batch.column(0)):
            names, scores = predict(held, data, bounds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())], schema=RESULT
            )

    return with_results(docs, [text], results, RESULT, keep)


def predict(model: Model, data: np.ndarray, bounds: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The language of each text of a block, and its score."""
    gamma, before = word_labels(model, data, bounds)
    n = len(bounds) - 1
    counts = np.diff(before)
    texts = np.repeat(np.arange(n), counts)
    means = summed(gamma, texts, n) / np.maximum(counts, 1)[:, None]
    best, scores = means.argmax(axis=1), means.max(axis=1)
    ascii_letter = words.letters_before(data)
    sure = ascii_letter[bounds[1:]] > ascii_letter[bounds[:-1]]
    names = []
    for i in range(n):
        known = sure[i] or (
            counts[i] and any(map(str.isalpha, data[bounds[i] : bounds[i + 1]].tobytes().decode()))
        )
        names.append(model.labels[best[i]] if known else UNKNOWN)
        if not known:
            scores[i] = 0.0
    return names, np.minimum(scores, 1.0)


def word_labels(model: Model, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(label probabilities of each word of a block, words before each text)."""
    distinct, codes, before = lexicon(data, bounds)
    if not len(codes):
        return np.zeros((0, len(model.labels))), before
    buckets, of = features(distinct)
    scores = summed(model.weights[buckets], of, len(distinct))[codes]
    return marginals(scores, before, model)[0], before
