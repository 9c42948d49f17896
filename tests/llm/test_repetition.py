"""Periodic runs, benchmark windows and collocations against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

import compare
from offerwise.llm import collocations, contamination, oracles, periodic, queries

SF = "/root/testdata/sf0.001"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- periodic runs ----------------------------------------------------------------------------


def runs_by_definition(words):
    """Every lag's stretches of equal words, kept under the smallest lag with that stretch."""
    n, best = len(words), {}
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                best.setdefault((i - q, j), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def expected_runs(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted(runs_by_definition(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (
        doc_id,
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def found_runs(docs):
    seed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = periodic.digests(periodic.with_runs(docs, keep=["doc_id"], seed=seed))
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_runs_query(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    wanted = sorted((expected_runs(*r) for r in zip(docs.doc_id.tolist(), docs.text)), key=repr)
    got = queries.QUERIES["op11_periodic_runs"](spark, SF)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == wanted
    assert sum(r[1] for r in wanted) > 5


def test_runs_of_random_texts(docs_of):
    pick, texts = random.Random(5), []
    for _ in range(600):
        letters = "abcdefgh"[: pick.choice([1, 2, 2, 3, 8])]
        words = [pick.choice(letters) for _ in range(pick.choice([0, 1, 5, 6, 9, 40, 120]))]
        while pick.random() < 0.6:
            unit = [pick.choice(letters) for _ in range(pick.randint(1, 25))]
            at = pick.randint(0, len(words))
            words[at:at] = unit * pick.randint(2, 7) + unit[: pick.randint(0, len(unit))]
        texts.append(pick.choice([" ", "\n", " \t"]).join(words))
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    assert found_runs(docs_of(rows)) == sorted((expected_runs(i, t) for i, t, _, _ in rows), key=repr)


def test_runs_hard(hard):
    wanted = [expected_runs(r.doc_id, r.text) for r in hard.select("doc_id", "text").collect() if r.doc_id not in (4, 5)]
    got = found_runs(hard.where("doc_id is null or doc_id not in (4, 5)"))
    assert got == sorted(wanted, key=repr)
    assert found_runs(hard.limit(0)) == []
    whole = periodic.with_runs(hard.withColumn("runs", F.lit("mine")))
    assert whole.count() == hard.count() and set(whole.columns) == {*hard.columns, "n_words", "runs", "collapsed"}


def test_very_long_repetition(docs_of):
    texts = ["x " * 200_000, "a b a c " * 50_000, " ".join(str(i % 977 * (i % 977)) for i in range(200_000))]
    found = periodic.with_runs(docs_of([(i, t, None, None) for i, t in enumerate(texts)])).orderBy("doc_id").collect()
    assert [[tuple(x) for x in r.runs] for r in found] == [[(0, 200_000, 1)], [(0, 200_000, 4)], [(0, 200_000, 977)]]
    assert [r.collapsed for r in found][:2] == ["x", "a b a c"]


# --- benchmark windows ------------------------------------------------------------------------


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def expected_hits(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        words = words_of(text)
        for i in range(max(len(words) - 9, min(len(words), 1))):
            windows[tuple(words[i : i + 10])].add(item)
    out = []
    for doc_id, text in docs:
        words, hit, ids = words_of(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if owners := windows.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    ids |= owners
        out.append((doc_id, len(words), len(hit), sorted(str(i) for i in ids if i is not None), bool(hit)))
    return sorted(out, key=repr)


def found_hits(docs, items, **options):
    found = contamination.contaminated(docs, items, keep=["doc_id"], **options)
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_decontamination_sql(spark):
    got = queries.QUERIES["op12_decontamination"](spark, SF)
    assert compare.differences(got, compare.duck(SF), oracles.ORACLES["op12_decontamination"]) == []


@pytest.fixture()
def planted(spark, docs_of, hard):
    """Items that documents hold once, often, overlapping, in part, in other case and script."""
    pick = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "漢字", "ÀB"]
    items = [(i, " ".join(pick.choices(vocabulary, k=pick.choice([10, 11, 25])))) for i in range(12)]
    items += [(20, "One"), (21, "two words"), (22, ""), (23, None), (24, "?!"), (None, items[0][1]), (5, "Nine of ten words are not ten, but one window")]
    items += [(30, "a a a a a a a a a a"), (31, items[3][1]), (3, items[3][1])]
    docs = []
    for i in range(60):
        words = pick.choices(vocabulary, k=pick.choice([0, 3, 9, 40]))
        for _ in range(pick.randint(0, 3)):
            text = pick.choice(items)[1] or ""
            at = pick.randint(0, len(words))
            words[at:at] = text.split()[: pick.choice([9, 10, 99])]
        docs.append((i, pick.choice([" ", "--", "\n"]).join(words).swapcase(), None, None))
    docs += [(100, "a " * 37, None, None)] + [(200, "so " + items[0][1], None, None)] * 40
    return docs_of(docs).unionByName(hard), spark.createDataFrame(items, "item_id long, text string"), items


@pytest.mark.parametrize("options", [{}, {"block": 40}, {"shingle": 10}])
def test_planted_windows(planted, options):
    docs, table, items = planted
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    wanted = expected_hits(rows, items)
    assert found_hits(docs, table, **options) == wanted
    assert sum(r[4] for r in wanted) > 40


def test_decontamination_without_rows(planted):
    docs, items, _ = planted
    assert found_hits(docs.limit(0), items) == []
    clean = found_hits(docs, items.limit(0))
    assert len(clean) == docs.count() and not any(r[4] for r in clean)
    clash = contamination.contaminated(docs.withColumn("items", F.lit(1)).withColumn("digest", F.lit(2)), items)
    assert [r.digest for r in clash.collect()] == [2] * docs.count()


def test_decontamination_plan(spark):
    """No Python, and no document's words in an exchange."""
    found = queries.QUERIES["op12_decontamination"](spark, SF)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "CartesianProduct" not in plan


# --- collocations -----------------------------------------------------------------------------


def expected_phrases(rows, least=30, longest=4, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, all_counts in counts.items():
        often = {p: f for p, f in all_counts.items() if f >= least}
        rows = []
        for p, a in often.items():
            if len(p) == 1:
                continue
            cuts = [(2_000_000 * a // (often[p[:c]] + often[p[c:]]), c) for c in range(1, len(p))]
            score, c = min(cuts)
            if not any(
                len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * f >= 80 * a
                for q, f in often.items()
            ):
                rows.append((-score, -a, " ".join(p).encode(), often[p[:c]], often[p[c:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def found_phrases(docs, **options):
    return sorted(tuple(r) for r in collocations.collocations(docs, **options).collect())


def test_collocations_sql(spark):
    got = queries.QUERIES["op13_collocations"](spark, SF)
    assert compare.differences(got, compare.duck(SF), oracles.ORACLES["op13_collocations"]) == []


@pytest.fixture()
def phrases(docs_of, hard):
    pick, rows = random.Random(9), []
    for i in range(900):
        words = pick.choices([f"w{j}" for j in range(12)] + ["É", "漢字"], weights=range(14, 0, -1), k=pick.choice([0, 1, 8, 30]))
        for _ in range(pick.randint(0, 2)):
            at = pick.randint(0, len(words))
            words[at:at] = pick.choice(["new york city", "New  York\tcity hall", "again and again and", "x"]).split(" ")
        rows.append((i, pick.choice([" ", " ", ", ", "\n"]).join(words), pick.choice(["en", "en", "de", None, "und"]), None))
    return docs_of(rows).unionByName(hard.where("doc_id is null or doc_id not in (4, 5, 6)"))


@pytest.mark.parametrize(
    "options", [{}, {"shards": 5}, {"bits": 3, "shards": 1}, {"least": 3, "longest": 2, "top": 5}]
)
def test_phrases(phrases, options):
    rows = [(r.lang, r.text) for r in phrases.select("lang", "text").collect()]
    plain = {k: v for k, v in options.items() if k not in ("shards", "bits")}
    wanted = expected_phrases(rows, **plain)
    assert found_phrases(phrases, **{"bits": 16} | options) == wanted
    assert len(wanted) > 8


def test_phrases_late_in_the_table(docs_of):
    """Words that reach the threshold with the last rows only: longer phrases begin in later cycles."""
    rows = [(i, "p q r s" if i % 2 else "z", "en", None) for i in range(60)]
    got = found_phrases(docs_of(rows), shards=3, bits=16)
    assert got == [("en", 1, "p q r s", 30, 30, 30, 150, 1_000_000)]
    assert found_phrases(docs_of(rows[:59]), bits=16) == []


def test_phrases_without_words(docs_of, hard):
    assert found_phrases(hard.limit(0), bits=16) == []
    assert found_phrases(docs_of([(1, None, None, None), (2, " .,", "en", None)]), bits=16) == []
    assert len(found_phrases(hard.where("doc_id = 6 or doc_id = 4"), bits=16, least=1)) > 1000


def test_scores_past_64_bits(spark):
    big = 9_000_000_000_000
    rows = [("en", 1, "a", big + 7), ("en", 1, "b", big), ("en", 2, "a b", big)]
    score = collocations.scored(spark.createDataFrame(rows, "lang string, k int, phrase string, f long")).first()
    assert (score.score, score.l, score.r) == (2_000_000 * big // (2 * big + 7), big + 7, big)
