"""Exact dedup, SimHash and the run-length index against brute force."""

import hashlib
import re
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash

import corpus_pipeline
from pyspark.sql import functions as F

from offerwise.llm import components, exact, queries, runindex, simhash

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{SF}/documents.parquet")


def sha(text):
    return hashlib.sha256((text or "").translate(LOWER).encode()).hexdigest()


def simhash_of(text, width=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + width]) for i in range(max(1, len(found) - width + 1))]
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def test_exact_query(spark, documents):
    got = queries.QUERIES["op3_exact_dedup"](spark, SF).toPandas().set_index("doc_id")
    documents = documents.assign(sha=documents.text.map(sha))
    groups = documents.groupby("sha").doc_id.agg(["max", "size"])
    assert len(got) == len(documents)
    for i, s in zip(documents.doc_id, documents.sha, strict=True):
        keep, size = groups.loc[s]
        assert tuple(got.loc[i, ["keep_id", "group_size", "kept", "text_sha256"]]) == (keep, size, keep == i, s)


def test_exact_hard(spark, hard):
    got = exact.exact_duplicates(hard).collect()
    assert len(got) == hard.count()
    empty = [r for r in got if r.text_sha256 == sha("")]
    assert {(r.keep_id, r.group_size) for r in empty} == {(2, 3)}
    fox = [r for r in got if r.doc_id == 7]
    assert {(r.keep_id, r.group_size, r.kept) for r in fox} == {(7, 3, True)}
    assert [r.kept for r in got if r.doc_id in (4, 5)] in ([False, True], [True, False])
    left = exact.without_duplicates(hard)
    assert left.columns == hard.columns
    assert sorted((r.doc_id or 0, r.digest) for r in left.collect()) == [
        (i, "b") for i in (0, 2, 3, 5, 6, 7, 8)
    ]
    assert exact.exact_duplicates(hard.limit(0)).collect() == []
    assert exact.without_duplicates(hard.limit(0)).collect() == []


def digests(*texts):
    return [bytes.fromhex(sha(t)) for t in texts]


def test_index_takes_new_and_removed_documents(spark, docs_of):
    first = docs_of([(1, "x", None, None), (2, "X", None, None), (3, "y", None, None)])
    more = docs_of([(9, "y", None, None), (5, "z", None, None)])
    grouped = [exact.grouped(exact.digests(d, keep=["doc_id"]), "doc_id") for d in (first, more)]
    index = exact.insert(exact.insert(exact.empty_index(spark, 10), grouped[0]), grouped[1])
    probes = spark.createDataFrame([(d,) for d in digests("x", "y", "z", "new")], "digest binary")

    def held(index):
        return {bytes(r.digest): (r.n, r.keep) for r in exact.lookup(index, probes).collect()}

    x, y, z, new = digests("x", "y", "z", "new")
    assert held(index) == {x: (2, 2), y: (2, 9), z: (1, 5), new: (None, None)}
    gone = exact.digests(docs_of([(9, "y", None, None), (5, "z", None, None)]), keep=["doc_id"])
    index = exact.delete(index, gone, exact.digests(first, keep=["doc_id"]), "doc_id")
    assert held(index) == {x: (2, 2), y: (1, 3), z: (None, None), new: (None, None)}


def test_cuckoo_filter_overflows_and_forgets():
    keys = np.random.default_rng(1).integers(0, 256, (5000, 32), dtype=np.uint8)
    small = exact.CuckooFilter(64)
    assert not small.insert(keys)
    held = exact.filled(keys, 100)
    assert held.contains(keys).all() and held.buckets >= 1250
    held.delete(keys[:2500])
    assert held.contains(keys[2500:]).all()
    assert held.contains(keys[:2500]).mean() < 0.01


def brute_components(values):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def test_simhash_query(spark, documents):
    got = queries.QUERIES["op9_simhash"](spark, SF).toPandas().set_index("doc_id").loc[documents.doc_id]
    prints = [simhash_of(t) for t in documents.text]
    assert list(got.fingerprint) == [f"{p:016x}" for p in prints]
    roots = pd.Series(brute_components(prints), index=documents.doc_id)
    least = roots.index.to_series().groupby(roots.values).min()
    assert list(got.component_id) == list(least.loc[roots.values])


def test_links_join_all_within_two_bits(spark):
    random = np.random.default_rng(3)
    values = [int(v) for v in random.integers(0, 1 << 62, 20)]
    values += [v ^ (1 << int(random.integers(64))) ^ (1 << int(random.integers(64))) for v in values for _ in range(6)]
    values = sorted(set(values))
    nodes = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "simhash bigint")
    roots = {r.node: r.root for r in components.components(simhash.links(nodes)).collect()}
    truth = brute_components(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    mine = [roots.get(v, v) for v in signed]
    assert len(set(mine)) == len(set(truth)) == len(set(zip(mine, truth, strict=True)))


def test_components_of_a_long_path(spark):
    edges = spark.range(300).selectExpr("id a", "id + 1 b")
    assert {r.root for r in components.components(edges).collect()} == {0}
    assert components.components(edges.limit(0)).collect() == []


def test_simhash_hard(spark, hard):
    got = simhash.near_duplicates(hard).collect()
    assert len(got) == hard.count()
    assert {r.component_id for r in got if r.doc_id in (1, 2, 3)} == {1}
    left = simhash.without_near_duplicates(hard)
    assert left.columns == hard.columns
    assert sorted((r.doc_id or 0, r.simhash) for r in left.collect())[1:] == [(i, "c") for i in (1, 4, 6, 7, 7, 8)]
    assert simhash.near_duplicates(hard.limit(0)).collect() == []


def brute_repeats(texts):
    """Per (key, text): (bytes, removed, runs, digest of the rest)."""
    first = {}
    for key, text in texts:
        raw = (text or "").encode()
        for p in range(len(raw) - 49 if key is not None else 0):
            first[raw[p : p + 50]] = min(key, first.get(raw[p : p + 50], key))
    out = []
    for key, text in texts:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 49 if key is not None else 0):
            if first[raw[p : p + 50]] < key:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((key, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r))


def test_repeats_query(spark, documents):
    got = [tuple(r) for r in queries.QUERIES["op6_run_index"](spark, SF).collect()]
    assert order(got) == order(brute_repeats(list(zip(documents.doc_id, documents.text, strict=True))))


def test_repeats_with_frequent_anchors_and_hard_rows(spark, docs_of, hard, monkeypatch):
    monkeypatch.setattr(runindex, "SAMPLED", 1)
    passage = "A passage that very many documents hold, with some words to spare. "
    rows = [(100 + i, f"start {i} " * (i % 9) + passage + f" end {i * 7919} " * (i % 5), None, None) for i in range(60)]
    rows += [(r.doc_id, r.text, None, None) for r in hard.collect()]
    rows += [(300, passage * 3, None, None), (301, passage * 3, None, None), (302, "ab" * 500, None, None)]
    docs = docs_of(rows)
    got = [tuple(r) for r in runindex.without_repeats(docs).collect()]
    assert order(got) == order(brute_repeats([(r[0], r[1]) for r in rows]))
    assert runindex.without_repeats(docs.limit(0)).collect() == []


def test_run_index_matches_brute_force():
    random = np.random.default_rng(1)
    for _ in range(20):
        base = random.integers(97, 100, 400).astype(np.uint8)
        strings = []
        for _ in range(int(random.integers(1, 40))):
            at, size = int(random.integers(0, 300)), int(random.integers(50, 77))
            piece = base[at : at + size].copy()
            if random.random() < 0.5:
                piece[int(random.integers(0, size))] = 97
            strings.append(piece.tobytes())
        doc = random.integers(0, 15, len(strings))
        ends = np.concatenate(([0], np.cumsum([len(s) for s in strings])))
        got = runindex.repeated(np.frombuffer(b"".join(strings), np.uint8), ends, doc)
        for i, s in enumerate(strings):
            earlier = [t for t, d in zip(strings, doc, strict=True) if d < doc[i]]
            mask = sum(1 << p for p in range(len(s) - 49) if any(s[p : p + 50] in t for t in earlier))
            assert mask == got[i]


def test_run_index_keeps_to_little_memory():
    """What a task holds besides its rows: one index, or the arrays of a block of text."""
    base = np.random.default_rng(4).integers(97, 123, 1_000_000).astype(np.uint8)
    bodies = [base[i * 11 : i * 11 + 50 + i % 27].tobytes() for i in range(runindex.SHARD)]
    numbers = pa.array(np.arange(runindex.SHARD))
    shard = pa.table({"h": numbers, "c": numbers, "doc": numbers, "body": pa.array(bodies, pa.binary())})
    texts = pa.array([base[i : i + 5000].tobytes().decode() for i in range(0, 1_000_000, 5000)])
    tracemalloc.start()
    try:
        assert runindex._indexed(shard).num_rows > 0
        assert tracemalloc.get_traced_memory()[1] < 40e6
        tracemalloc.reset_peak()
        before, width = tracemalloc.get_traced_memory()[0], 0
        for _, data, bounds in runindex.words.blocks(texts, runindex.BLOCK):
            runindex.anchors(data, bounds)
            width += len(data)
        assert width == 1_000_000
        assert tracemalloc.get_traced_memory()[1] - before < 20e6
    finally:
        tracemalloc.stop()


def test_anchors_are_dealt_evenly(spark, docs_of):
    random = np.random.default_rng(5)
    texts = [random.integers(97, 123, 4000).astype(np.uint8).tobytes().decode() for _ in range(40)]
    docs = docs_of([(2 * i + j, t + "!" * j, None, None) for i, t in enumerate(texts) for j in (0, 1)])
    cls = F.shiftrightunsigned(F.xxhash64("text"), 24)
    none = spark.sparkContext.broadcast(np.zeros(0, np.uint64))
    shared = runindex._shared(docs.select("text", cls.alias("cls")), none, 5).select("h").toPandas().h
    sizes = np.bincount(shared.to_numpy() >> 40, minlength=32)
    assert len(sizes) == 32 and sizes.max() < 2 * sizes.mean()


def test_stage_keeps_one_of_each_component(spark, docs_of, hard):
    """Near copies, NULL, empty and repeated rows, against fingerprints compared pair by pair."""
    pick = np.random.default_rng(3)
    rows = []
    for i in range(80):
        text = [f"w{x}" for x in pick.integers(0, 5000, int(pick.integers(1, 900)))]
        for n in range(4):
            copy = list(text)
            if n:
                copy[int(pick.integers(0, len(copy)))] = f"new{n}"
            rows.append((1000 + 10 * i + n, " ".join(copy), "en", None))
    docs = docs_of(rows).unionByName(hard).withColumn("_print", F.lit(1)).withColumn("_copy", F.lit("mine"))
    prints = [(r.doc_id, r.text, r.simhash % (1 << 64)) for r in simhash.fingerprints(docs, 3).collect()]
    group = list(range(len(prints)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][2] ^ prints[j][2]).bit_count() <= 2:
                group[root(i)] = root(j)
    keys = {}
    for i, (key, _, _) in enumerate(prints):
        keys.setdefault(root(i), []).append(key)
    wanted = {min((k for k in found if k is not None), default=None) for found in keys.values()}
    left = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert left.columns == docs.columns
    kept = left.collect()
    assert {r.doc_id for r in kept} == wanted and all(r._copy == "mine" and r._print == 1 for r in kept)
    assert len(kept) == len({(r.doc_id, r.text) for r in kept}) < len(prints) - 100
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), "").collect() == []


def test_index_grows_past_its_shards(spark, docs_of, monkeypatch):
    """Ten times the keys: shards are dealt anew from stored keys, and nothing is lost."""
    monkeypatch.setattr(exact, "KEYS_PER_SHARD", 40)
    index, shards = exact.empty_index(spark, 40), []
    for step in (1, 3, 10):
        rows = [(1000 * step + i, f"text {i}", None, None) for i in range(40 * step)]
        index = exact.insert(index, exact.grouped(exact.digests(docs_of(rows), keep=["doc_id"]), "doc_id"))
        shards.append(index.shards)
    assert shards == sorted(set(shards)) and shards[-1] >= 10
    probes = exact.digests(docs_of([(0, f"text {i}", None, None) for i in range(450)]))
    found = exact.lookup(index, probes).groupBy("n").count().collect()
    assert {r.n: r["count"] for r in found} == {3: 40, 2: 80, 1: 280, None: 50}
    assert index.filters.count() == index.keys.select("shard").distinct().count()


def test_copies_meet_in_the_index(spark, docs_of):
    """Copies come in different batches, so that their counts and keys are those of hits."""
    docs = docs_of([(i, f"text {i % 7}", None, None) for i in range(70)])
    batch = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(1)), F.lit(exact.BATCHES))
    parts = docs.groupBy("text").agg(F.count_distinct(batch).alias("batches")).collect()
    assert min(r.batches for r in parts) > 1
    rows = exact.exact_duplicates(docs).collect()
    assert {(r.doc_id % 7, r.keep_id, r.group_size) for r in rows} == {(i, 63 + i, 10) for i in range(7)}


def test_radius_of_links(spark):
    nodes = spark.createDataFrame([(0,), (0b1111,), (-1,)], "simhash bigint")
    assert simhash.links(nodes).collect() == []
    assert [tuple(r) for r in simhash.links(nodes, radius=4).collect()] == [(0, 0b1111)]
