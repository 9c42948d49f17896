"""Benchmark decontamination: a prefix-filtered set join of item windows and documents.

An item's windows are its stretches of WIDTH words; a document is contaminated where one of
them occurs. A window is a set of shingles, and a document that holds the window holds all of
them, so its rarest shingle alone is the necessary prefix: only the places in documents where
that shingle stands are joined. There the window's place is known, bounds on position and
length apply, and the words are compared.

Everything is DataFrame functions. Documents are never shuffled: their words are hashed in the
scan and looked up in broadcast shingles, which go out in blocks of at most BLOCK rows of fixed
size, one pass over the documents for each block. Only places that match are grouped, by a
digest of the text, so that copies of a text count once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from offerwise.llm.tables import attach, store

WIDTH = 10
SHINGLE = 3

# Rows of under 200 bytes in memory that are broadcast at a time.
BLOCK = 200_000

# What separates words, and the letters that are lowered.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; NULL has none."""
    given = F.coalesce(text, F.lit(""))
    # `lower` is faster, but alike only where there is nothing but ASCII.
    plain = F.octet_length(given) == F.char_length(given)
    low = F.when(plain, F.lower(given)).otherwise(F.translate(given, UPPER, UPPER.lower()))
    return F.array_remove(F.split(low, BETWEEN), "")


def _digest(sequence: Column) -> Column:
    """32 bytes that tell sequences of words apart; no word holds a space."""
    return F.unhex(F.sha2(F.array_join(sequence, " "), 256))


def _shingle(sequence: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(sequence, at + i) for i in range(size)])


def windows(items: DataFrame, item: str, text: str, width: int = WIDTH) -> DataFrame:
    """(item, digest, words) of all windows of all items; an item of fewer words is one window."""
    rows = items.select(
        F.col(f"`{item}`").cast("string").alias("item"), words(F.col(f"`{text}`")).alias("all")
    ).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - width + 1, F.lit(1)))
    cut = rows.withColumn("start", F.explode_outer(starts)).select(
        "item", F.slice("all", F.col("start"), width).alias("words")
    )
    return cut.withColumn("digest", _digest(F.col("words")))


def _places(texts: DataFrame, size: int) -> DataFrame:
    """`texts` (digest, words) with a row for each shingle: its place and hash."""
    # The outer form keeps the optimizer from splitting every text once more for a filter.
    return (
        texts.select("*", F.posexplode_outer("words").alias("place", "word"))
        .where(F.col("place") + size <= F.size("words"))
        .withColumn("shingle", _shingle(F.col("words"), F.col("place"), size))
    )


def _blocks(table: DataFrame, key: str, block: int) -> list[DataFrame]:
    """The rows of a stored table in parts that may be broadcast, all rows of a key in one; a
    key with more rows than fit, whose rows differ in `digest`, is dealt out as well."""
    n = max(1, -(-table.count() // (block // 2)))
    if n == 1:
        return [table]
    dealt = F.pmod(F.xxhash64(key, "digest"), F.lit(n))
    return [table.where(dealt == i) for i in range(n)]


def rarest(texts: DataFrame, wanted: DataFrame, size: int, block: int = BLOCK) -> DataFrame:
    """The prefix of each window in `wanted` (digest, words): the place and hash of that shingle
    which occurs least in `texts`, and the number of its words. Windows of which some shingle
    occurs nowhere are left out: neither do they."""
    parts = _places(wanted, size).select("digest", "shingle", "place", F.size("words").alias("n"))
    parts = store(parts, "window-shingles")
    distinct = store(parts.select("shingle", F.col("shingle").alias("digest")).distinct(), "shingles")
    places = _places(texts.select("words"), size).select("shingle")
    counts = [
        places.join(F.broadcast(b.select("shingle")), "shingle").groupBy("shingle").agg(F.count("*").alias("f"))
        for b in _blocks(distinct, "shingle", block)
    ]
    counted = reduce(DataFrame.unionByName, counts)
    first = F.min(F.struct("f", "place", "shingle", "n"))
    return (
        parts.join(counted, "shingle", "left")
        .withColumn("f", F.coalesce("f", F.lit(0)))
        .groupBy("digest")
        .agg(first.alias("least"))
        .where("least.f > 0")
        .select("digest", "least.place", "least.shingle", "least.n")
    )


def occurrences(
    texts: DataFrame, wanted: DataFrame, shingle: int = SHINGLE, block: int = BLOCK
) -> DataFrame:
    """(digest, start, n, window, copies): where windows (digest, words) occur in texts (digest,
    words); `copies` is how many rows have that text. Start counts words from 0."""
    # Windows shorter than a shingle are their own shingle, of a size of its own.
    of_size = F.least(F.size("words"), F.lit(shingle))
    sizes = [r[0] for r in wanted.select(of_size).distinct().collect()] or [shingle]
    start = F.col("place") - F.col("at")
    found = []
    for size in sorted(sizes):
        prefix = store(rarest(texts, wanted.where(of_size == size), size, block), "prefixes")
        places = _places(texts, size).drop("word")
        for part in _blocks(prefix, "shingle", block):
            part = part.select("shingle", F.col("digest").alias("window"), F.col("place").alias("at"), "n")
            near = places.join(F.broadcast(part), "shingle").where(
                (start >= 0)
                & (start + F.col("n") <= F.size("words"))
                & (_digest(F.slice("words", start + 1, F.col("n"))) == F.col("window"))
            )
            found.append(near.select("digest", start.alias("start"), "n", "window"))
    # Counted by part before they move: a text copied often is one row from each task.
    return reduce(DataFrame.unionByName, found).groupBy("digest", "start", "n", "window").agg(
        F.count("*").alias("copies")
    )


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    keep: list[str] | None = None,
    width: int = WIDTH,
    shingle: int = SHINGLE,
    block: int = BLOCK,
) -> DataFrame:
    """`docs` (or its columns `keep`) with n_words, n_hit, items and contaminated.

    n_hit counts the words that lie in some occurrence of a window, `items` lists the items whose
    windows occur, as strings in byte order, each once. NULL, empty and wordless texts have no
    words and hit nothing, nor do such items. Items of fewer than `width` words are one window.
    An item without an id marks words, but is not listed; items that repeat an id are one in the
    list. Repeated rows and equal texts have equal results. Without documents there are no rows,
    without items nothing is hit. Columns of `docs` called like an added one are replaced. Texts
    of any length are read whole.
    """
    added = ("n_words", "n_hit", "items", "contaminated")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    given = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    texts = docs.select(F.unhex(F.sha2(given, 256)).alias("digest"), words(given).alias("words"))

    cut = store(windows(items, item, item_text, width), "windows")
    wanted = cut.dropDuplicates(["digest"]).select("digest", "words")
    hits = store(occurrences(texts, store(wanted, "distinct-windows"), shingle, block), "occurrences")

    # Words under hits: what each one adds to those that start before it.
    end = F.col("start") + F.col("n")
    spans = hits.groupBy("digest", "start").agg(F.max("n").alias("n"), F.max("copies").alias("copies"))
    before = F.max(end).over(
        W.partitionBy("digest").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    )
    new = F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(before, F.lit(0))))
    covered = spans.select("digest", "copies", new.alias("new")).groupBy("digest").agg(
        F.sum("new").alias("n_hit"), F.max("copies").alias("copies")
    )
    # Texts with the same windows have the same items, which are listed once for all of them.
    sets = hits.groupBy("digest").agg(F.array_sort(F.collect_set("window")).alias("set"))
    sets = store(
        sets.withColumn("kind", F.sha2(F.array_join(F.transform("set", F.hex), ""), 256)), "hit-windows"
    )
    owners = cut.select("item", F.col("digest").alias("window")).distinct()
    kinds = sets.groupBy("kind").agg(F.first("set").alias("set"))
    listed = (
        kinds.select("kind", F.explode("set").alias("window"))
        .join(owners, "window")
        .groupBy("kind")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    results = covered.join(sets.select("digest", "kind").join(listed, "kind"), "digest").drop("kind")

    rows = docs.select(
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]).alias("kept"),
        F.unhex(F.sha2(given, 256)).alias("digest"),
        F.size(words(given)).cast("bigint").alias("n_words"),
    )
    found = attach(rows, store(results, "contaminated"), ["digest"], "copies", F.col("kept"))
    return found.select(
        *[F.col(f"kept.c{i}").alias(c) for i, c in enumerate(kept)],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
