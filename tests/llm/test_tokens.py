"""BPE and Simple-8b against the tokenizers library and exact round trips."""

import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from offerwise.llm import bpe, queries, simple8b, words

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "",
    "Hello wörld it's 123 foo!! ñ <|endoftext|> x",
    "ÀÉÎ×÷ßÿ ſ ΑΣ ΣΑΣ",
    "a" * 30_000,
    "x<|startoftext|>y's 'S 'LL don't é  a　b c\x1fd\x85e İstanbul ŉ İ 漢字かな \U0001f600\U0001f44d\U0001f3fd ½ ²  Ⅳ ١٢",
    "<|endoftext|><|endoftext|>",
    "hel\x00lo \x7f",
    "ab" * 60,
    "'s's't ''re",
    "q̣̇ ̈́ ᾴ Å",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")


def encoded(texts):
    tool, out = bpe.encoder(PATH), []
    for _, data, bounds in words.blocks(pa.array(texts, pa.string())):
        ids, ends = bpe.encode_block(tool, data, bounds)
        out += [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return out


def test_odd_texts(library):
    assert encoded(ODD) == [e.ids for e in library.encode_batch(ODD, add_special_tokens=False)]
    assert encoded([None]) == [[]]


def test_words_of_any_length_merge_alike(library):
    random = np.random.default_rng(2)
    texts = ["".join(random.choice(list("thequickan"), n)) for n in (1, 2, 40, 47, 48, 49, 50, 200, 3000)]
    assert encoded(texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_bpe_query(spark, library, documents):
    got = queries.QUERIES["op10_bpe"](spark, SF).toPandas().sort_values("doc_id")
    for text, n, ids_sha, text_sha in zip(documents.text, got.n_tokens, got.ids_sha256, got.decoded_sha256, strict=True):
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert n == len(ids)
        assert ids_sha == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert text_sha == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_hard(spark, hard, library):
    got = bpe.encode_decode(hard, out="texts").collect()
    assert len(got) == hard.count()
    for row in got:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids == ids and row.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode_decode(hard.limit(0)).collect() == []


@pytest.mark.parametrize("most", [1, 2, 60, 49_408, 1 << 32, 1 << 63])
@pytest.mark.parametrize("n", [0, 1, 5, 1023, 1024, 1025, 5000])
def test_round_trip(n, most):
    random = np.random.default_rng(n)
    ids = random.integers(0, most, n, dtype=np.uint64)
    if n > 10:
        ids[random.integers(0, n, n // 10)] = 0
        ids[5] = most
    packed, offsets = simple8b.encode(ids)
    assert (simple8b.decode(packed, offsets, n) == ids).all()


def test_small_ids_share_words():
    assert len(simple8b.encode(np.zeros(1024, np.uint64))[0]) == 5
    assert len(simple8b.encode(np.full(1000, 32_767))[0]) == 250


def test_simple8b_query(spark, library, documents):
    got = queries.QUERIES["op7_simple8b"](spark, SF).toPandas().sort_values("doc_id")
    at = 0
    for text, start, n, crc in zip(documents.text, got.start, got.n_tokens, got.ids_crc32, strict=True):
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        assert (start, n, crc) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += n


def test_simple8b_hard(spark, hard, library, tmp_path):
    folder = str(tmp_path / "tokens")
    simple8b.write_tokens(hard, folder)
    got = sorted(simple8b.read_tokens(spark, folder, ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [1, 2, 3, 4, 5, 6, 7, 7, 7, 8, None, None]
    wanted = sorted(
        (r.doc_id or 0, [*library.encode(r.text or "", add_special_tokens=False).ids, 2]) for r in hard.collect()
    )
    assert sorted((r.doc_id or 0, r.ids) for r in got) == wanted
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert simple8b.packed_tokens(hard.limit(0)).collect() == []
