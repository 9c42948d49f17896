"""Toxicity by votes of the nearest labelled examples under exact TF-IDF cosine.

Examples live in a block-max inverted index: for each term and each block of BLOCK
consecutive vectors the largest weight is kept, so that the sum of a query's weights times
a block's maxima bounds every cosine in the block. Blocks are scored from the best bound
down until no bound reaches the k-th best cosine: the neighbours are exact.

Terms are those whose presence makes the label likelier than not, with more evidence
(likelihood ratio against the label's share overall) than the best of as many terms would
have by chance. Their document frequencies come from all documents. Examples
with equal vectors are one entry with counts.

A text without any such term is not judged by its silence: it is compared, by all its words,
with a part of the examples that is indexed by all of theirs (see `Whole`), so that what is
near a labelled text is found whatever words they share. Near is a cosine of at least `near`
(0.5): below it lies whatever shares a language, and no bound could rule blocks out. How much
the label of a near text says is learned too: the weight of the prior in these votes is the
one under which examples without a term, each judged by the others, are likeliest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from offerwise.llm import words
from offerwise.llm.blockmax import BlockMaxIndex
from offerwise.llm.columns import with_results

BLOCK = 64
PREFIX = 4
# Texts are as near as they get at this distance.
NEAR = 0.02
PRIORS = [2.0 * 4**i for i in range(8)]
PREFIXED = np.uint64(0xA24BAED4963EE407)


@dataclass
class Whole:
    """Examples by all their words: sorted hashes of the words, their idf, and the vectors."""

    terms: np.ndarray
    idf: np.ndarray
    index: BlockMaxIndex
    label: np.ndarray
    vote: np.ndarray  # of how many examples each stands
    example: np.ndarray
    unseen: float  # idf of a word that no example has
    prior: float = 2.0  # votes that the label's share among texts without a term counts for

    @staticmethod
    def of(terms, idf, entries, labels, examples, votes=None, unseen=0.0) -> Whole:
        """From each example's (term numbers, counts)."""
        # Examples of one language have its most frequent words; blocks shall hold such alike.
        common = np.argsort(idf, kind="stable")[:24]
        rank = np.full(len(terms), -1, np.int64)
        rank[common] = np.arange(len(common))
        marks = [int((np.int64(1) << rank[t][rank[t] >= 0]).sum()) for t, _ in entries]
        order = sorted(range(len(entries)), key=lambda i: (marks[i], i))
        parts = [(np.full(len(entries[i][0]), n), *entries[i]) for n, i in enumerate(order)]
        none = np.zeros(0, np.int64)
        vector, term, count = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (none,) * 3
        weight = (1 + np.log(np.maximum(count, 1))) * idf[term]
        lengths = np.sqrt(np.bincount(vector, weight * weight, len(entries)))
        index = BlockMaxIndex(vector, term, weight / lengths[vector], len(entries), len(terms))
        votes = np.ones(len(entries)) if votes is None else votes
        return Whole(
            terms, idf, index, *(np.array([x[i] for i in order], float) for x in (labels, votes)),
            np.array([examples[i] for i in order]), unseen,
        )

    def votes(self, vectors, cosines) -> tuple[float, float]:
        """(for the label, in all). They fall with the square of the distance, so that near
        copies outweigh the rest."""
        votes = self.vote[vectors] * (cosines / (1 - cosines + NEAR)) ** 2
        return float((votes * self.label[vectors]).sum()), float(votes.sum())

    def learn_prior(self, entries, bare, share: float, k: int, least: float) -> None:
        """Choose `prior` by the log loss of the examples in `bare`, each judged by the others."""
        number = {key: i for i, key in enumerate(self.example.tolist())}
        judged = []
        for key in bare:
            own = number[key]
            vectors, cosines = self.near(*entries[key], k + 1, least=least)
            others = vectors != own
            if others.any():
                judged.append((*self.votes(vectors[others], cosines[others]), self.label[own], self.vote[own]))
        if not judged:
            return
        hits, votes, label, weight = np.array(judged).T
        losses = []
        for prior in PRIORS:
            score = np.clip((hits + prior * share) / (votes + prior), 1e-9, 1 - 1e-9)
            losses.append(-(weight * np.where(label == 1, np.log(score), np.log(1 - score))).sum())
        self.prior = PRIORS[int(np.argmin(losses))]

    def near(self, numbers, counts, k: int, others=(), least: float = 0.0):
        """The k nearest examples of cosine `least` or more; `others`: counts of the words
        that no example has, which only make the text longer."""
        weights = (1 + np.log(counts)) * self.idf[numbers]
        rest = (1 + np.log(others)) * self.unseen if len(others) else np.zeros(0)
        length = np.sqrt((weights * weights).sum() + (rest * rest).sum())
        return self.index.nearest(numbers, weights / length, k, least)


@dataclass
class Index:
    """Distinct example vectors (unit length) as postings by term, with block maxima."""

    terms: np.ndarray  # sorted 64-bit hashes of the terms
    idf: np.ndarray
    vectors: list  # per vector: (term numbers, counts)
    positive: np.ndarray  # examples with the label, per vector
    total: np.ndarray
    example: np.ndarray  # the smallest key among a vector's examples
    empty: tuple[float, float]  # the same counts for examples without any term
    base: float
    k: int
    prior: float
    whole: Whole | None = None
    near: float = 0.5
    postings: list = field(default_factory=list)
    maxima: np.ndarray | None = None

    def __post_init__(self):
        entries: list[list] = [[] for _ in self.terms]
        blocks = -(-len(self.vectors) // BLOCK)
        self.maxima = np.zeros((len(self.terms), max(1, blocks)))
        for i, (numbers, counts) in enumerate(self.vectors):
            weights = self.weigh(numbers, counts)
            for term, weight in zip(numbers, weights, strict=True):
                entries[term].append((i, weight))
                block = i // BLOCK
                self.maxima[term, block] = max(self.maxima[term, block], weight)
        for entry in entries:
            at = np.array([e[0] for e in entry], np.int64)
            starts = np.searchsorted(at, np.arange(blocks + 1) * BLOCK)
            self.postings.append((at, np.array([e[1] for e in entry]), starts))

    def weigh(self, numbers, counts) -> np.ndarray:
        weights = (1 + np.log(counts)) * self.idf[numbers]
        return weights / np.sqrt((weights * weights).sum())

    def nearest(self, numbers, counts) -> list[tuple[float, int]]:
        """(cosine, vector) of the k nearest examples, ties at the last place included."""
        query = self.weigh(numbers, counts)
        bounds = query @ self.maxima[numbers]
        found: list[tuple[float, int]] = []
        least = 0.0
        for block in np.argsort(-bounds, kind="stable"):
            if bounds[block] <= 0 or bounds[block] < least - 1e-9:
                break
            scores = np.zeros(BLOCK)
            for term, weight in zip(numbers, query, strict=True):
                at, weights, starts = self.postings[term]
                part = slice(starts[block], starts[block + 1])
                scores[at[part] - block * BLOCK] += weight * weights[part]
            inside = np.flatnonzero((scores > 0) & (scores >= least - 1e-9))
            found += [(round(float(scores[i]), 9), int(block * BLOCK + i)) for i in inside]
            found.sort(key=lambda x: (-x[0], x[1]))
            covered = 0
            for place, (score, vector) in enumerate(found):
                covered += self.total[vector]
                if covered >= self.k:
                    least = score
                    last = place + 1
                    while last < len(found) and found[last][0] >= least:
                        last += 1
                    found = found[:last]
                    break
        return found

    def score_whole(self, numbers, counts, others) -> tuple[float, list[int], list[float]]:
        """Like `score`, by all words of a text without any term; without a near example, the
        label's share among examples without terms."""
        share = self.bare_share()
        vectors, cosines = self.whole.near(numbers, counts, self.k, others, self.near)
        if not len(vectors):
            return share, [], []
        hits, votes = self.whole.votes(vectors, cosines)
        score = (hits + self.whole.prior * share) / (votes + self.whole.prior)
        return score, [int(self.whole.example[v]) for v in vectors[:5]], cosines[:5].tolist()

    def bare_share(self) -> float:
        """The label's share among examples without a term, smoothed."""
        positive, total = self.empty
        return (positive + self.prior * self.base) / (total + self.prior)

    def score(self, numbers, counts) -> tuple[float, list[int], list[float]]:
        """(score, keys of near examples, their cosines): cosine-weighted, smoothed votes."""
        found = self.nearest(numbers, counts)
        votes = sum(c * self.total[v] for c, v in found)
        hits = sum(c * self.positive[v] for c, v in found)
        score = (hits + self.prior * self.base) / (votes + self.prior)
        shown = found[:5]
        return float(score), [int(self.example[v]) for _, v in shown], [c for c, _ in shown]


def _terms(data: np.ndarray, bounds: np.ndarray):
    """(text, hash) of every term in a block: each word in lower case, and its first
    PREFIX bytes if it is longer, so that forms of a word that were not learned count too.
    Words come first; the third result is their number."""
    data = words.lowered(data)
    starts, ends, before = words.spans(data, bounds, letters=True)
    long_ = np.flatnonzero(ends - starts > PREFIX)
    found = words.hashes(
        data, np.append(starts, starts[long_]), np.append(ends, starts[long_] + PREFIX)
    )
    found[len(starts) :] ^= PREFIXED
    texts = np.repeat(np.arange(len(bounds) - 1), np.diff(before))
    return np.append(texts, texts[long_]), found, len(starts)


def _counted(terms: np.ndarray, texts: np.ndarray, found: np.ndarray):
    """(text, term, count) triples of the terms among (text, hash), by text and term."""
    if not len(found) or not len(terms):
        return (np.zeros(0, np.int64),) * 3
    # Most words are no term: a table by the lowest bits turns them away first.
    low = np.zeros(1 << 16, bool)
    low[(terms & np.uint64(0xFFFF)).astype(np.int64)] = True
    maybe = np.flatnonzero(low[(found & np.uint64(0xFFFF)).astype(np.int64)])
    at = np.minimum(np.searchsorted(terms, found[maybe]), len(terms) - 1)
    hit = terms[at] == found[maybe]
    pairs, counts = np.unique(
        texts[maybe[hit]] * len(terms) + at[hit], return_counts=True
    )
    return pairs // len(terms), pairs % len(terms), counts


def _split(text: np.ndarray, term: np.ndarray, count: np.ndarray, n: int) -> list:
    cuts = np.searchsorted(text, np.arange(n + 1))
    return [(term[a:b], count[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _each(terms: np.ndarray, batch: pa.RecordBatch):
    """Per text of a batch: (term numbers, counts)."""
    for _, data, bounds in words.blocks(batch.column(0)):
        yield _split(*_counted(terms, *_terms(data, bounds)[:2]), len(bounds) - 1)


def _words(texts: np.ndarray, found: np.ndarray):
    """(text, hash, count) of the distinct words among (text, hash), by text and hash."""
    order = np.lexsort((found, texts))
    found, texts = found[order], texts[order]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (texts[1:] != texts[:-1])
    first = np.flatnonzero(fresh)
    return texts[first], found[first], np.diff(np.append(first, len(found)))


def _known_words(terms: np.ndarray, texts: np.ndarray, found: np.ndarray):
    """(text, word number, count) of distinct words, by text and word; -1: not in `terms`."""
    text, found, count = _words(texts, found)
    if not len(terms):
        return text, np.full(len(text), -1), count
    at = np.minimum(np.searchsorted(terms, found), len(terms) - 1)
    return text, np.where(terms[at] == found, at, -1), count


def fit(
    docs: DataFrame,
    labelled: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "label",
    examples: int = 20_000,
    terms: int = 4096,
    least: int = 5,
    k: int = 25,
    prior: float = 2.0,
    whole: int = 4096,
    whole_bytes: int = 32 << 20,
    near: float = 0.5,
) -> Index:
    """Learn from `labelled` (key, label 0/1) the texts of `docs`.

    At most `examples` labelled documents (those with the smallest hashed keys) and `terms`
    terms, in at least `least` examples each, are taken; `whole` of them, evenly by label and as
    far as they have `whole_bytes` bytes, are indexed by all words too, where texts of cosine
    `near` or more are neighbours. All bounds hold at any size. A key with several texts is
    learned with the smallest of them.
    NULL and empty texts, no labels and empty tables leave an index that gives the base share.
    Labels that are NULL are left out; a key labelled more than once has its largest label.
    """
    rows = (
        labelled.where(F.col(label).isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max(label).cast("int").alias("_label"))
        .join(docs.select(F.col(key).alias("_key")).distinct(), "_key", "left_semi")
        .orderBy(F.xxhash64("_key"), "_key")
        .limit(examples)
    )
    chosen = docs.sparkSession.createDataFrame(
        [tuple(r) for r in rows.collect()], rows.schema  # bounded by `examples`
    )
    # A text a key: rows that repeat a key do not add to what is learned and gathered.
    sample = (
        docs.join(F.broadcast(chosen), docs[key] == chosen["_key"])
        .groupBy("_key")
        .agg(F.min(text).alias("_text"), F.max("_label").alias("_label"))
        .select("_text", "_key", "_label")
    )
    totals = {r[0]: r[1] for r in chosen.groupBy("_label").count().collect()}
    positive, count = totals.get(1, 0), sum(totals.values())
    seen = sample.select("_text", "_label").mapInArrow(_present, "term bigint, label int, n bigint")
    shares = seen.groupBy("term").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("hits")
    )
    base = positive / count if count else 0.0
    n, share = F.col("n"), F.col("hits") / F.col("n")
    rare = F.when(share < 1, (1 - share) * F.log((1 - share) / max(1 - base, 1e-9))).otherwise(0.0)
    evidence = n * (share * F.log(share / max(base, 1e-9)) + rare)
    tested = shares.where((n >= least) & (share > 0.5)).withColumn("evidence", evidence)
    chance = float(np.log(max(1, shares.where(n >= least).count()))) + 2
    picked = tested.where(F.col("evidence") > chance).orderBy(F.desc("evidence"), "term").limit(terms)
    hashed = np.sort(
        np.array([r["term"] for r in picked.select("term").collect()], np.int64).view(np.uint64)
    )
    # Document frequencies over all documents.
    frequencies = docs.select(F.col(text)).mapInArrow(_frequencies(hashed), "term int, n bigint")
    df, all_docs = np.zeros(len(hashed)), 0
    for r in frequencies.groupBy("term").agg(F.sum("n").alias("n")).collect():
        if r["term"] < 0:
            all_docs = r["n"]
        else:
            df[r["term"]] = r["n"]
    idf = np.log((1 + all_docs) / (1 + df)) + 1

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [v for part in _each(hashed, batch) for v in part]
            columns = [
                batch.column(1),
                batch.column(2),
                pa.array([v[0].tolist() for v in made], pa.list_(pa.int64())),
                pa.array([v[1].tolist() for v in made], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "label", "terms", "counts"])

    key_type = docs.schema[key].dataType.simpleString()
    each = sample.mapInArrow(
        vectors, f"key {key_type}, label int, terms array<bigint>, counts array<bigint>"
    )
    distinct = each.groupBy("terms", "counts").agg(
        F.sum("label").alias("hits"), F.count(F.lit(1)).alias("n"), F.min("key").alias("key")
    )
    entries = distinct.orderBy("terms", "counts").collect()  # bounded by `examples`
    bare = [e for e in entries if not e["terms"]]
    entries = [e for e in entries if e["terms"]]
    index = Index(
        terms=hashed,
        idf=idf,
        vectors=[(np.array(e["terms"]), np.array(e["counts"])) for e in entries],
        positive=np.array([e["hits"] for e in entries], float),
        total=np.array([e["n"] for e in entries], float),
        example=np.array([e["key"] for e in entries]),
        empty=(float(bare[0]["hits"]), float(bare[0]["n"])) if bare else (0.0, 0.0),
        base=base,
        k=k,
        prior=prior,
        near=near,
    )
    index.whole, vectors_of, without = _whole(docs, sample, text, hashed, all_docs, whole, whole_bytes)
    index.whole.learn_prior(vectors_of, without, index.bare_share(), k, near)
    return index


def _whole(
    docs: DataFrame, sample: DataFrame, text: str, hashed, all_docs: int, most: int, most_bytes: int
) -> tuple[Whole, dict, list]:
    """`most` examples, as many of each label while there are, up to `most_bytes`, by all their
    words. Each votes for as many as its label has among the examples for one taken. Also
    their vectors by key, and the keys of those without any term in `hashed`."""
    one = sample.where(F.octet_length("_text") > 0)
    # One task ranks the bounded examples by size only; texts are joined after.
    sizes = one.select(
        "_key", "_label", F.octet_length("_text").alias("bytes"), F.xxhash64("_key").alias("place")
    )
    turn = F.row_number().over(W.partitionBy("_label").orderBy("place", "_key"))
    of_label = F.count(F.lit(1)).over(W.partitionBy("_label"))
    order = W.orderBy("turn", "_label")
    ranked = (
        sizes.select("_key", "bytes", "_label", turn.alias("turn"), of_label.alias("of_label"))
        .withColumns({"n": F.row_number().over(order), "so_far": F.sum("bytes").over(order)})
        .where((F.col("n") <= most) & (F.col("so_far") <= most_bytes))
        .select("_key", "of_label")
    )
    key = sample.schema["_key"].dataType.simpleString()

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, bounds in words.blocks(batch.column(0)):
                texts, found, n = _terms(data, bounds)
                made = _split(*_words(texts[:n], found[:n]), len(bounds) - 1)
                columns = [
                    *[batch.column(i).slice(first, len(made)) for i in (1, 2, 3)],
                    pa.array(np.bincount(_counted(hashed, texts, found)[0], minlength=len(made))),
                    pa.array([m[0].view(np.int64) for m in made], pa.list_(pa.int64())),
                    pa.array([m[1] for m in made], pa.list_(pa.int64())),
                ]
                names = ["key", "label", "of_label", "held", "terms", "counts"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = one.join(ranked, "_key").select("_text", "_key", "_label", "of_label").mapInArrow(
        vectors,
        f"key {key}, label int, of_label bigint, held bigint, terms array<bigint>, counts array<bigint>",
    )
    # Bounded by `most_bytes`; as Arrow, since rows of Python numbers take ten times the room.
    got = rows.toArrow()
    keys = got["key"].to_pylist()
    at = sorted(range(len(keys)), key=lambda i: str(keys[i]))
    hashes = [got["terms"][i].values.to_numpy().view(np.uint64) for i in at]
    counts = [got["counts"][i].values.to_numpy() for i in at]
    labels = got["label"].to_numpy()[at].astype(int)
    taken = np.bincount(labels, minlength=2)
    votes = got["of_label"].to_numpy()[at] / taken[labels]
    votes = votes / (votes.min() if len(votes) else 1)
    terms = np.unique(np.concatenate([*hashes, np.zeros(0, np.uint64)]))
    df = np.zeros(len(terms))
    counted = docs.select(F.col(text)).mapInArrow(_word_frequencies(terms), "term int, n bigint")
    sums = counted.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    df[sums["term"].to_numpy()] = sums["n"].to_numpy()
    idf = np.log((1 + all_docs) / (1 + df)) + 1
    unseen = float(np.log((1 + all_docs) / 2) + 1)
    numbers = [np.searchsorted(terms, h) for h in hashes]
    pairs = list(zip(numbers, counts, strict=True))
    keys = [keys[i] for i in at]
    bare = [key for key, n in zip(keys, got["held"].to_numpy()[at], strict=True) if not n]
    made = Whole.of(terms, idf, pairs, labels, keys, votes, unseen)
    return made, dict(zip(keys, pairs, strict=True)), bare


def _word_frequencies(terms: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(terms), np.int64)
        for batch in batches:
            for _, data, bounds in words.blocks(batch.column(0)):
                texts, found, n = _terms(data, bounds)
                number = _known_words(terms, texts[:n], found[:n])[1]
                df += np.bincount(number[number >= 0], minlength=len(terms))
        some = np.flatnonzero(df)
        columns = [pa.array(some.astype(np.int32)), pa.array(df[some])]
        yield pa.RecordBatch.from_arrays(columns, names=["term", "n"])

    return run


def _present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of a block with each label hold each word."""
    for batch in batches:
        labels = batch.column(1).to_numpy(zero_copy_only=False)
        for first, data, bounds in words.blocks(batch.column(0)):
            texts, found, _ = _terms(data, bounds)
            order = np.lexsort((found, texts))
            found, texts = found[order], texts[order]
            fresh = np.ones(len(found), bool)
            fresh[1:] = (found[1:] != found[:-1]) | (texts[1:] != texts[:-1])
            found, label = found[fresh], labels[first + texts[fresh]]
            for value in (0, 1):
                term, n = np.unique(found[label == value], return_counts=True)
                columns = [pa.array(term.view(np.int64)), pa.array(np.full(len(term), value, np.int32)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, names=["term", "label", "n"])


def _frequencies(terms: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, df = 0, np.zeros(len(terms), np.int64)
        for batch in batches:
            total += batch.num_rows
            for _, data, bounds in words.blocks(batch.column(0)):
                _, term, _ = _counted(terms, *_terms(data, bounds)[:2])
                df += np.bincount(term, minlength=len(terms))[: len(terms)]
        numbers = np.append(np.arange(len(terms)), -1).astype(np.int32)
        columns = [pa.array(numbers), pa.array(np.append(df, total))]
        yield pa.RecordBatch.from_arrays(columns, names=["term", "n"])

    return run


RESULT = pa.schema(
    [
        ("score", pa.float64()),
        ("predicted", pa.int32()),
        ("neighbours", pa.list_(pa.int64())),
        ("cosines", pa.list_(pa.float64())),
    ]
)


def scored(docs: DataFrame, index: Index, text: str = "text", keep=None) -> DataFrame:
    """`docs` with score (0 to 1), predicted (score >= 0.5), and evidence: the keys of the
    nearest examples and their cosines.

    NULL texts and texts without words get the label's share among examples without terms, no
    neighbours, and so do all where nothing was learned. Equal texts and repeated rows have
    equal scores; ties at the last neighbour all vote. Very long texts are read whole. An empty
    table gives no rows. The index is sent to every task; the limits of `fit` bound its size.
    """
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def results(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        held = sent.value
        known: dict = {}
        for _, data, bounds in words.blocks(batch.column(0)):
            texts, found, n = _terms(data, bounds)
            part = _split(*_counted(held.terms, texts, found), len(bounds) - 1)
            bare = np.array([not len(p[0]) for p in part], bool)
            rest = np.flatnonzero(bare[texts[:n]])
            everything = _split(
                *_known_words(held.whole.terms, texts[rest], found[rest]), len(bounds) - 1
            )
            made = []
            for (numbers, counts), (every, times) in zip(part, everything, strict=True):
                if not len(numbers):
                    seen = every >= 0
                    made.append(held.score_whole(every[seen], times[seen], times[~seen]))
                    continue
                vector = (numbers.tobytes(), counts.tobytes())
                if vector not in known:
                    if len(known) > 20_000:
                        known.clear()
                    known[vector] = held.score(numbers, counts)
                made.append(known[vector])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([m[0] for m in made], pa.float64()),
                    pa.array([int(m[0] >= 0.5) for m in made], pa.int32()),
                    pa.array([m[1] for m in made], pa.list_(pa.int64())),
                    pa.array([m[2] for m in made], pa.list_(pa.float64())),
                ],
                schema=RESULT,
            )

    return with_results(docs, [text], results, RESULT, keep)
