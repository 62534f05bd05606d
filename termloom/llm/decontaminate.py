"""Benchmark decontamination by a prefix-filtered containment join.

An item's windows are its runs of `window` words (or all its words, if fewer). A document contains a
window if the words stand there in a row. All `gram`-word shingles of a window must then be there
too, so one of them, the rarest in the corpus, is enough to find candidates (the necessary prefix of
an exact containment). Candidates are checked against position and length bounds first, and word by
word afterwards. DataFrame functions only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.storage import fresh, keyed, stored

#: Tables of one number a row (shingles, documents) are broadcast up to this many rows, and joined by shuffle beyond.
BROADCAST_ROWS = 200_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; other letters stay."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words_of(text: Column) -> Column:
    """Words of a text in order; NULL has none."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(parts, lambda w: w != "")


def gram_keys(words: Column, size: int) -> Column:
    """(hash of `size` words) at each position."""
    at = F.sequence(F.lit(1), F.size(words) - (size - 1))
    return F.when(
        F.size(words) >= size,
        F.transform(at, lambda i: F.xxhash64(F.lit(size), *(F.get(words, i + (j - 1)) for j in range(size)))),
    ).otherwise(F.array().cast("array<bigint>"))


def windows_of(items: DataFrame, window: int, gram: int) -> DataFrame:
    """(item_id, w, length, key words) of every window; equal windows of one item count once."""
    words = items.select("item_id", words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (window - 1)))
    cut = words.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, window))).alias("w"))
    return cut.distinct().withColumn("length", F.size("w")).withColumn("size", F.least("length", F.lit(gram)))


def find_hits(docs: DataFrame, items: DataFrame, window: int = 10, gram: int = 3) -> DataFrame:
    """(doc_id, n_words, start, length, item_id): every occurrence of a window; start counts from 1.

    Documents without words, items without words and empty tables give no row; an item that occurs
    several times gives one row per occurrence and window. doc_id must not repeat or be NULL; callers pass a row key.
    """
    windows = stored(windows_of(items, window, gram))
    sizes = [r.size for r in windows.select("size").distinct().collect()]  # at most `gram` numbers
    offsets = windows.select(
        "item_id", "w", "length", "size", F.sequence(F.lit(1), F.col("length") - F.col("size") + 1).alias("at")
    )
    keyed = [
        offsets.filter(F.col("size") == s).select("item_id", "w", "length", F.posexplode(gram_keys(F.col("w"), s)).alias("offset", "key"))
        for s in sizes
    ]
    texts = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    if not keyed:
        return texts.select("doc_id", F.size("words").alias("n_words"), F.lit(1).alias("start"), F.lit(0).alias("length"), F.lit(0).cast("bigint").alias("item_id")).filter("false")
    grams = keyed[0]
    for other in keyed[1:]:
        grams = grams.union(other)
    grams = stored(grams)
    keys = grams.select("key").distinct()
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)

    # One pass over the corpus: the places of every benchmark shingle.
    every = F.concat(*(gram_keys(F.col("words"), s) for s in sizes)) if len(sizes) > 1 else gram_keys(F.col("words"), sizes[0])
    if len(sizes) > 1:
        every = F.flatten(F.array(*(F.transform(gram_keys(F.col("words"), s), lambda k, i: F.struct(i.alias("pos"), k.alias("key"))) for s in sizes)))
        places = texts.select("doc_id", F.size("words").alias("n_words"), F.explode(every).alias("p")).select("doc_id", "n_words", "p.pos", "p.key")
    else:
        places = texts.select("doc_id", F.size("words").alias("n_words"), F.posexplode(every).alias("pos", "key"))
    places = stored(places.join(keys, "key"))

    # The rarest shingle of each window is its prefix; shingles that never occur rule the window out.
    counts = places.groupBy("key").agg(F.count("*").alias("n"))
    rarity = grams.join(counts, "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    prefix = rarity.groupBy("item_id", "w", "length").agg(F.min(F.struct("n", "key", "offset")).alias("p")).filter("p.n > 0")
    prefix = prefix.select("item_id", "w", "length", "p.key", "p.offset")
    candidates = places.join(prefix, "key").withColumn("start", F.col("pos") - F.col("offset") + 1)
    candidates = candidates.filter("start >= 1 and start + length - 1 <= n_words")
    candidates = stored(candidates.select("doc_id", "n_words", "start", "length", "item_id", "w"))

    # One number a document, counted first: while it is small, texts are read again but not shuffled.
    wanted = stored(candidates.select("doc_id").distinct())
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    held = docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi").select("doc_id", words_of(F.col("text")).alias("words"))
    by_doc = candidates.groupBy("doc_id", "n_words").agg(F.collect_list(F.struct("start", "length", "item_id", "w")).alias("c"))
    checked = by_doc.join(held, "doc_id").select(
        "doc_id", "n_words", F.explode(F.filter("c", lambda x: F.slice("words", x["start"], x["length"]) == x["w"])).alias("c")
    )
    return checked.select("doc_id", "n_words", "c.start", "c.length", "c.item_id")


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, gram: int = 3) -> DataFrame:
    """One row per document: n_words, n_hit (words inside any occurrence), items (sorted ids), contaminated.

    A NULL or wordless text has 0 words and is clean; so is every text if there are no items. Every row
    is judged by its own text; doc_id may repeat or be NULL.
    """
    docs = keyed(docs.select("doc_id", "text"))
    hits = find_hits(docs.select(F.col("row_").alias("doc_id"), "text"), items, window, gram)
    per_doc = hits.groupBy(F.col("doc_id").alias("row_")).agg(
        F.size(F.array_distinct(F.flatten(F.collect_set(F.expr("sequence(start, start + length - 1)"))))).cast("bigint").alias("n_hit"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    total = F.size(words_of(F.col("text"))).cast("bigint")
    out = docs.select("row_", "doc_id", total.alias("n_words")).join(per_doc, "row_", "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, window: int = 10, gram: int = 3) -> DataFrame:
    """The documents that hold no window of any item; doc_id may repeat or be NULL."""
    (key,) = fresh(docs.columns, "row_")
    rows = keyed(docs, key)
    hit = find_hits(rows.select(F.col(key).alias("doc_id"), "text"), items, window, gram).select(F.col("doc_id").alias(key)).distinct()
    return rows.join(hit, key, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
