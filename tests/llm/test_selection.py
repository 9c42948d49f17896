"""Mixing, importance resampling, toxicity, languages, neighbours and the pipeline."""

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from offerwise.llm import crf, exact, importance, mixing, neighbours, queries, simhash, toxicity, words

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, copies=2):
    """Share and reshare until no target is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if copies * sizes[s] <= weight[s] * level}
        if not full:
            return target | {s: weight[s] * level for s in open_}
        for s in full:
            target[s] = float(copies * sizes[s])
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 1000, "c": 50, None: 7, "é": 12, "Z": 400},
        {"only": 5},
        {"a": 0, "b": 0},
        {"a": 10, "b": 10_000, "c": 3, "d": 3, "e": 0},
    ],
)
def test_targets(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.targets(table).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_mixing_query(spark):
    docs = pd.read_parquet(f"{LARGER}/documents.parquet")
    got = queries.QUERIES["op1_mixing"](spark, LARGER).toPandas()
    again = queries.QUERIES["op1_mixing"](spark.newSession(), LARGER).toPandas()
    columns = ["doc_id", "taken"]
    assert got[columns].sort_values("doc_id").values.tolist() == again[columns].sort_values("doc_id").values.tolist()
    both = got.merge(docs[["doc_id", "text", "source"]], on="doc_id")
    assert len(both) == len(docs)
    assert list(both["size"]) == [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in both.text]
    sums = both.groupby("source").agg(size=("size", "sum"), given=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))
    assert (sums["size"] == sums.given).all()
    wanted = brute_targets(sums["size"].to_dict())
    assert sums.target.to_dict() == pytest.approx(wanted)
    assert ((sums.taken - sums.target).abs() <= sums.most).all()
    assert abs(sums.taken.sum() - sums.target.sum()) <= sums.most.max()
    assert (both.taken <= 2 * both["size"]).all() and (both.taken % both["size"].clip(lower=1) == 0).all()


def test_mixing_hard(spark, hard):
    got = mixing.mixed(hard).collect()
    assert len(got) == hard.count()
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in got)
    mix = mixing.mix(hard)
    assert mix.columns == hard.columns
    assert mix.count() == sum(r.passes for r in got)
    assert mixing.mixed(hard.limit(0)).collect() == [] and mixing.mix(hard.limit(0)).collect() == []
    blank = hard.where("doc_id in (1, 2, 3)")
    assert {r.taken for r in mixing.mixed(blank).collect()} == {0}


def gram_counts(texts, buckets):
    out = np.ones(buckets)
    for _, data, bounds in words.blocks(pa.array(texts, pa.string())):
        np.add.at(out, importance._grams(data, bounds, buckets)[1], 1)
    return out


def test_importance_query(spark):
    docs = pd.read_parquet(f"{LARGER}/documents.parquet")
    labels = pd.read_parquet(f"{LARGER}/labels.parquet")
    got = queries.QUERIES["op4_importance"](spark, LARGER).toPandas()
    assert sorted(got["rank"]) == list(range(len(docs)))
    assert (got.sort_values("gumbel_key", ascending=False)["rank"].diff().dropna() == 1).all()
    assert got.selected.sum() == (got["rank"] < got.selected.sum()).sum()
    out = got.merge(labels, on="doc_id")
    held = out[[zlib_mod(i) == 0 for i in out.doc_id]]
    assert held[held.quality == 1].log_weight.median() > 0 > held[held.quality == 0].log_weight.median()
    assert out[out.quality == 1].selected.mean() > 0.95
    # The ratios are those of plain counts.
    chosen = {i for i, q in zip(labels.doc_id, labels.quality, strict=True) if q == 1 and zlib_mod(i) != 0}
    target = gram_counts(docs[docs.doc_id.isin(chosen)].text, 500)
    raw = gram_counts(docs.text, 500)
    frame = spark.read.parquet(f"{LARGER}/documents.parquet")
    fitted = importance.fit(frame, spark.createDataFrame([(i,) for i in chosen], "doc_id bigint"), buckets=500)
    assert np.allclose(fitted, np.log(target / target.sum()) - np.log(raw / raw.sum()))


def zlib_mod(i, n=5):
    import zlib

    return zlib.crc32(str(i).encode()) % n


def test_importance_hard(spark, hard):
    ratios = importance.fit(hard, hard.where("doc_id = 4"))
    got = importance.resampled(hard, ratios, 0.5).collect()
    assert len(got) == hard.count() and sum(r.selected for r in got) == round(hard.count() / 2)
    assert {r.log_weight for r in got if r.n_grams == 0} == {0.0}
    assert importance.resampled(hard.limit(0), ratios, 0.5).collect() == []


def test_toxicity_on_held_out_rows(spark):
    labels = pd.read_parquet(f"{LARGER}/labels.parquet")
    got = queries.QUERIES["op5_toxicity"](spark, LARGER).toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.5)).all()
    assert (got.held_out == [zlib_mod(i) == 0 for i in got.doc_id]).all()
    out = got.merge(labels, on="doc_id")
    assert out[out.predicted == 1].toxic.mean() > 0.95
    assert out[out.toxic == 1].predicted.mean() > 0.6


def toxic_index(random, vectors, terms=40):
    made = {}
    for _ in range(vectors):
        numbers = np.unique(random.integers(0, terms, random.integers(1, 6)))
        made[tuple(numbers), tuple(random.integers(1, 4, len(numbers)))] = 1
    n = len(made)
    total = random.integers(1, 4, n).astype(float)
    return toxicity.Index(
        terms=np.arange(terms, dtype=np.uint64), idf=random.uniform(1, 5, terms),
        vectors=[(np.array(a), np.array(b)) for a, b in made], positive=np.floor(total * random.random(n)),
        total=total, example=np.arange(n), empty=(1.0, 10.0), base=0.1, k=7, prior=2.0,
    )


def test_block_max_search_is_exact():
    random = np.random.default_rng(4)
    index = toxic_index(random, 500)
    dense = np.zeros((len(index.vectors), 40))
    for i, (numbers, counts) in enumerate(index.vectors):
        dense[i, numbers] = index.weigh(numbers, counts)
    for numbers, counts in index.vectors[::7]:
        query = np.zeros(40)
        query[numbers] = index.weigh(numbers, counts)
        cosines = np.round(dense @ query, 9)
        order = np.lexsort((np.arange(len(cosines)), -cosines))
        covered = np.cumsum(index.total[order])
        least = cosines[order[np.argmax(covered >= index.k)]]
        wanted = [i for i in order if cosines[i] >= least and cosines[i] > 0]
        assert [v for _, v in index.nearest(numbers, counts)] == wanted


def test_many_sources_are_ranked_by_shuffle(spark, docs_of):
    """The way taken when the sources do not fit one task gives the same mix."""
    random = np.random.default_rng(2)
    rows = [
        (i, "word " * int(random.integers(0, 60)), "en", None if i % 41 == 0 else f"s{int(random.zipf(1.4)) % 90}")
        for i in range(900)
    ]
    docs = docs_of(rows)
    few = {r.doc_id: tuple(r) for r in mixing.mixed(docs).collect()}
    many = {r.doc_id: tuple(r) for r in mixing.mixed(docs, few_sources=0).collect()}
    assert len(few) == 900
    assert all(many[i][:3] == few[i][:3] and many[i][3] == pytest.approx(few[i][3]) for i in few)
    assert sum(many[i][4] != few[i][4] for i in few) <= 1
    assert mixing.mixed(docs.limit(0), few_sources=0).collect() == []


def test_words_taken_follow_the_finish_times(spark, docs_of):
    """The mix against plain weighted fair queueing over the shuffled queues."""
    random = np.random.default_rng(7)
    docs = docs_of([(i, "w " * int(random.integers(0, 30)), "en", "abc"[int(random.integers(0, 3))]) for i in range(200)])
    rows = mixing.mixed(docs).collect()
    line = []
    for source in {r.source_size for r in rows}:
        queue = sorted((r for r in rows if r.source_size == source), key=lambda r: (r._row, r.doc_id))
        served = 0
        for turn in range(2):
            for r in queue:
                served += r["size"]
                if r["size"]:
                    line.append((served / r.target, turn, r.doc_id, r["size"]))
    budget, taken = sum({r.source_size: r.target for r in rows}.values()), {}
    spent = 0
    for _, _, doc, size in sorted(line):
        if spent + size > budget + 0.5:
            break
        spent += size
        taken[doc] = taken.get(doc, 0) + size
    assert {r.doc_id: r.taken for r in rows if r.taken} == taken


def test_columns_of_any_name_and_kind_are_kept(spark, docs_of):
    docs = docs_of([(i % 7, f"text {i % 5}", "en", "a") for i in range(30)])
    for name in ("_row", "_first", "_copy", "_key", "_passes", "_own", "_doc_id", "_print"):
        docs = docs.withColumn(name, F.concat(F.lit("mine "), F.col("doc_id")))
    docs = docs.withColumn("map", F.create_map(F.lit("k"), F.col("doc_id")))
    for made in (mixing.mix(docs), exact.without_duplicates(docs), simhash.without_near_duplicates(docs)):
        assert made.columns == docs.columns
        got = made.collect()
        assert got and all(r._row == r._own == r._copy == r._print == f"mine {r.doc_id}" for r in got)
        assert all(r.map == {"k": r.doc_id} for r in got)


def test_all_words_are_searched_exactly():
    random = np.random.default_rng(8)
    for n, n_terms in ((1, 5), (63, 30), (700, 300)):
        entries = []
        for _ in range(n):
            numbers = np.unique(random.zipf(1.3, random.integers(1, 40)) % n_terms)
            entries.append((numbers, random.integers(1, 5, len(numbers))))
        idf = random.uniform(1, 5, n_terms)
        whole = toxicity.Whole.of(np.arange(n_terms, dtype=np.uint64), idf, entries, [0] * n, list(range(n)))
        dense = np.zeros((n, n_terms))
        for row, i in enumerate(whole.example):
            numbers, counts = entries[i]
            dense[row, numbers] = (1 + np.log(counts)) * idf[numbers]
        dense /= np.sqrt((dense**2).sum(1))[:, None]
        for numbers, counts in entries[::11]:
            query = np.zeros(n_terms)
            query[numbers] = (1 + np.log(counts)) * idf[numbers]
            cosines = np.round(dense @ (query / np.sqrt((query**2).sum())), 9)
            order = np.lexsort((np.arange(n), -cosines))
            order = order[cosines[order] > 0]
            least = cosines[order[min(9, len(order)) - 1]]
            found, cosine = whole.near(numbers, counts, 9)
            wanted = order[cosines[order] >= least]
            assert sorted(np.round(cosine, 7)) == sorted(np.round(cosines[wanted], 7))
            assert set(found) == set(wanted) or np.allclose(cosines[found], cosines[wanted])
            # With a bound below, and words of the text that no example has.
            found, cosine = whole.near(numbers, counts, 9, least=0.4)
            assert set(found) == {i for i in wanted if cosines[i] >= 0.4}
            whole.unseen = 6.0
            _, less = whole.near(numbers, counts, 9, np.array([2, 1]))
            rest = 36 * ((1 + np.log(2)) ** 2 + 1)
            shorter = np.sqrt((query**2).sum() / ((query**2).sum() + rest))
            assert np.allclose(sorted(less), sorted(cosines[wanted] * shorter), atol=1e-8)


def test_toxic_text_without_an_indicator_is_found(spark, docs_of):
    """Labelled texts share no telling word; a near copy of one has its label."""
    random = np.random.default_rng(6)

    def word(x):
        return "".join(chr(97 + int(c)) for c in str(x))  # digits are no letters

    texts = [" ".join(word(x) for x in random.zipf(1.2, 120) % 4000) for _ in range(120)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(120)], "doc_id long, label int")
    rows = [(i, t, None, None) for i, t in enumerate(texts)]
    for i, text in enumerate(texts):
        words_ = text.split()
        words_[int(random.integers(0, 120))] = "changed"
        rows.append((1000 + i, " ".join(words_).upper(), None, None))
    docs = docs_of(rows)
    index = toxicity.fit(docs, labels)
    assert not len(index.terms)
    got = {r.doc_id: r for r in toxicity.scored(docs, index).collect()}
    wrong = [i for i in range(120) if got[1000 + i].predicted != int(i % 4 == 0)]
    assert wrong == []
    assert all(got[1000 + i].neighbours[0] == i and got[1000 + i].cosines[0] > 0.8 for i in range(120))
    # Both bounds hold.
    few = toxicity.fit(docs, labels, whole=50)
    assert few.whole.index.n == 50
    assert toxicity.fit(docs, labels, whole_bytes=3000).whole.index.n in range(1, 12)


def test_toxicity_hard(spark, hard):
    labels = spark.createDataFrame([(4, 1), (7, 0), (7, None), (None, 1), (99, 1)], "doc_id bigint, label int")
    got = toxicity.scored(hard, toxicity.fit(hard, labels)).collect()
    assert len(got) == hard.count() and all(0 <= r.score <= 1 for r in got)
    nothing = toxicity.fit(hard.limit(0), labels.limit(0))
    assert {r.predicted for r in toxicity.scored(hard, nothing).collect()} == {0}
    assert toxicity.scored(hard.limit(0), nothing).collect() == []


def test_language_query(spark):
    got = queries.QUERIES["op8_language"](spark, SF).toPandas().merge(
        pd.read_parquet(f"{SF}/documents.parquet")[["doc_id", "lang"]], on="doc_id"
    )
    assert (got.held_out == [zlib_mod(i, 3) == 1 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all()
    assert (got.lang_pred == got.lang)[got.held_out].mean() > 0.97


def plain_messages(emit, step, start):
    out = []
    x = emit[0] * start
    for t in range(len(emit)):
        x = x if t == 0 else emit[t] * (x @ step)
        x = x / x.sum()
        out.append(x)
    return np.array(out)


def test_segments_give_the_plain_recursion():
    random = np.random.default_rng(5)
    bounds = np.concatenate(([0], np.cumsum([1, 31, 32, 33, 0, 400, 2])))
    emit, step = random.random((bounds[-1], 3)) + 0.01, random.random((3, 3)) + 0.01
    start = np.array([0.2, 0.5, 0.3])
    got = crf.messages(emit, bounds, step, start)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b > a:
            assert np.allclose(got[a:b], plain_messages(emit[a:b], step, start))


def test_words_of_a_text_that_switches_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = crf.fit(docs, F.lit(True), examples=120, rounds=15)
    local = pd.read_parquet(f"{SF}/documents.parquet")
    some = {g: " ".join(t.split()[:40]) for g, t in zip(local.lang, local.text, strict=True) if len(t.split()) >= 40}
    mixed = some["de"] + " " + some["fr"]
    data = np.frombuffer(mixed.encode(), np.uint8)
    gamma, _ = crf.word_labels(model, data, np.array([0, len(data)]))
    best = [model.labels[i] for i in gamma.argmax(axis=1)]
    half = len(best) // 2
    assert best[: half - 5].count("de") > 0.8 * (half - 5) and best[half + 5 :].count("fr") > 0.8 * (len(best) - half - 5)


def test_language_hard(spark, hard):
    model = crf.fit(hard, F.lit(True), rounds=3)
    got = crf.labelled(hard, model).collect()
    assert len(got) == hard.count()
    for row in got:
        letters = any(map(str.isalpha, row.text or ""))
        assert (row.lang_pred in model.labels) if letters else (row.lang_pred, row.score) == ("und", 0.0)
    empty = crf.fit(hard.limit(0), F.lit(True))
    assert crf.labelled(hard.limit(0), empty).collect() == []
    assert crf.labelled(hard, empty).count() == hard.count()


def test_neighbours_recall(spark):
    # Without merging of small partitions, as on a larger table.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = queries.QUERIES["op2_neighbours"](spark, LARGER).toPandas()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    table = pd.read_parquet(f"{LARGER}/embeddings.parquet")
    x, ids = np.stack(table.embedding).astype(float), table.vec_id.to_numpy()
    found = 0
    asked = ids[ids % 20 == 0]
    assert sorted(set(got.query_id)) == sorted(asked)
    for q, part in got.groupby("query_id"):
        scores = (x * x[ids == q]).sum(axis=1)
        part = part.sort_values("rank")
        assert list(part["rank"]) == list(range(1, 21)) and q not in set(part.vec_id)
        assert np.allclose(part.score, [scores[ids == v][0] for v in part.vec_id], atol=1e-12)
        others = ids != q
        best = ids[others][np.lexsort((ids[others], -scores[others]))][:20]
        found += len(set(best) & set(part.vec_id))
    assert found / (20 * len(asked)) >= 0.9


def test_neighbours_hard(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(100 + i, [0.5, float(i)]) for i in range(5)]
    rows += [(200, None), (220, [0.0, 0.0]), (240, [nan, 1.0]), (260, [inf, 1.0]), (280, [None, 1.0]), (300, []), (None, [1.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("rank", F.lit("x"))
    got = neighbours.nearest(vectors, F.col("vec_id") % 20 == 0).toPandas()
    assert sorted(set(got.query_id)) == [0, 20, 40, 100]
    for q, part in got.groupby("query_id"):
        mine = dict(r for r in rows if r[0] == q)[q]
        good = [(i, np.dot(v, mine)) for i, v in rows[:65] if i != q]
        best = sorted(good, key=lambda r: (-r[1], r[0]))[:20]
        part = part.sort_values("rank")
        assert list(zip(part.vec_id, part.score, strict=True)) == best
    few = vectors.where("vec_id in (0, 1, 100)")
    assert neighbours.nearest(few, F.col("vec_id") == 0).count() == 2
    assert neighbours.nearest(few.limit(0), F.col("vec_id") == 0).collect() == []


def test_neighbours_of_each_length(spark):
    rows = [(i, [1.0, float(i)]) for i in range(5)] + [(10 + i, [float(i), 1.0, 1.0]) for i in range(3)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = neighbours.nearest(vectors, F.col("vec_id").isin(1, 10)).collect()
    assert {(r.query_id, r["rank"], r.vec_id) for r in got} == {
        (1, 1, 4), (1, 2, 3), (1, 3, 2), (1, 4, 0), (10, 1, 11), (10, 2, 12)
    }


def test_pipeline_stages_keep_columns_and_decisions(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = pd.read_parquet(f"{LARGER}/labels.parquet")
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, LARGER)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.columns == docs.columns
        got[name] = made.toPandas()
        docs = spark.createDataFrame(got[name], made.schema)
    clean, exact_, near, mix, final = got.values()
    assert len(clean) > len(exact_) >= len(near) > 0
    toxic = set(labels[labels.toxic == 1].doc_id)
    assert len(set(clean.doc_id) & toxic) < 0.4 * len(toxic)
    assert exact_.text.str.lower().is_unique
    assert set(mix.doc_id) <= set(near.doc_id) and mix.doc_id.value_counts().max() <= 2
    assert len(final) == len(mix)


def test_pipeline_query(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
