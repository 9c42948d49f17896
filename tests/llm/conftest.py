import pytest
from pyspark.sql import Row

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint,"
    # Names that operators give to columns of their own.
    " score string, digest string, simhash string, n_tokens string, size string, rank string"
)
EXTRA = ("a", "b", "c", "d", "e", "f")


@pytest.fixture()
def docs_of(spark):
    """A `documents` table with clashing extra columns, from (doc_id, text, lang, source)."""

    def make(rows):
        full = [(i, t, g, s, None if t is None else len(t), *EXTRA) for i, t, g, s in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture()
def hard(docs_of):
    """NULLs in every column, empty, blank, very long and repeated texts, repeated rows and ids."""
    words = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    return docs_of(
        [
            (1, None, None, None),
            (2, "", "en", "b"),
            (3, " \t\n", "en", "b"),
            (4, words, "en", "a"),
            (5, words, "en", "a"),
            (6, "a" * 90_000, None, "a"),
            (7, "The quick brown fox; jumps over the lazy dog!", "en", None),
            (7, "The quick brown fox; jumps over the lazy dog!", "en", None),
            (7, "the QUICK brown fox; jumps over the lazy dog!", "en", "c"),
            (8, "Über straße 漢字 \U0001f600 é", "de", "c"),
            (None, "no key", "fr", "a"),
            (None, None, None, None),
        ]
    )


def rows(df):
    return [Row(**r.asDict()) for r in df.collect()]
