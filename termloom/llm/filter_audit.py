"""Interaction of document filters, from one stored table of failing ids per filter.

What a filter removes depends only on the set of filters before it, not on their order. So survivors are
found once for each of the 2^n sets, by left-anti joins of the failing rows with the tables of failing
ids, and the removals of a filter behind a set by a left-semi join of those survivors with its table. Rows
that fail nothing survive every set and are only counted.
"""

from __future__ import annotations

import hashlib
import itertools
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.storage import stored

# The filters, in the order of their bits, and their limits.
FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_CAPITALS_PERCENT = 10
SYMBOLS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Bytes of a text that are split into words at a time.
PIECE_BYTES = 1 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def word_counts(data: bytes) -> tuple[int, int]:
    """Words and distinct words; a long text is split piece by piece, at blanks."""
    if len(data) <= PIECE_BYTES:
        words = data.split()
        return len(words), len(set(words))
    count, seen, at = 0, set(), 0
    while at < len(data):
        blank = _BLANK.search(data, at + PIECE_BYTES)
        end = blank.end() if blank else len(data)
        words = data[at:end].split()
        count, at = count + len(words), end
        seen.update(words)
    return count, len(seen)


def failed_alone(data: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words, distinct = word_counts(data)
    points = sum(len(data[i : i + PIECE_BYTES].translate(None, bytes(range(0x80, 0xC0)))) for i in range(0, len(data), PIECE_BYTES))
    capitals = len(data) - len(data.translate(None, CAPITALS))
    return (
        (words < LEAST_WORDS)
        | (100 * distinct < LEAST_DISTINCT_PERCENT * words) << 1
        | (100 * capitals > MOST_CAPITALS_PERCENT * points) << 2
        | (len(data.translate(None, SYMBOLS)) < len(data)) << 3
    )


def _measure(batches):
    for batch in batches:
        bits, digests = [], []
        for text in batch.column("text").cast(pa.binary()):
            data = text.as_py() or b""
            bits.append(failed_alone(data))
            digests.append(hashlib.sha256(data).digest())
        kept = [batch.column(c) for c in ("row", "doc_id", "part")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(bits, pa.int32()), pa.array(digests, pa.binary())], names=["row", "doc_id", "part", "bits", "digest"])


def measured(docs: DataFrame) -> DataFrame:
    """(row, doc_id, part, bits, digest) of every document, stored; texts are read only here."""
    some = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        "text",
    )
    kinds = [T.StructField("row", T.LongType()), T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("part", T.StringType()), T.StructField("bits", T.IntegerType()), T.StructField("digest", T.BinaryType())]
    return stored(some.mapInArrow(_measure, T.StructType(kinds)))


def failing_ids(rows: DataFrame) -> DataFrame:
    """(row, filter), stored with one folder per filter.

    E: the smallest doc_id of each text passes; a left-anti join on doc_id and digest finds the others, so a
    text with very many copies meets in no task. A row without doc_id is neither smaller nor larger.
    """
    alone = F.array(*[F.when(F.col("bits").bitwiseAND(1 << i) != 0, F.lit(f)) for i, f in enumerate(FILTERS[:4])])
    own = rows.select("row", F.explode(F.array_compact(alone)).alias("filter"))
    known = rows.filter("doc_id is not null")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    copies = known.join(first, ["digest", "doc_id"], "left_anti")
    return stored(own.union(copies.select("row", F.lit("E"))), "filter")


def survivors(members: DataFrame, fails: DataFrame, filters: str) -> DataFrame:
    """members with `gone`, once for each set of filters (its bits) that they survive."""
    alive = members.withColumn("gone", F.lit(0))
    for i, name in enumerate(filters):
        bit = 1 << i
        alive = alive.withColumn("gone", F.explode(F.array(F.col("gone"), F.col("gone") + bit)))
        bad = fails.filter(F.col("filter") == name).select(F.col("row").alias("bad"))
        alive = alive.join(bad, (F.col("row") == F.col("bad")) & (F.col("gone").bitwiseAND(bit) != 0), "left_anti")
    return alive


def removals(alive: DataFrame, fails: DataFrame, filters: str) -> DataFrame:
    """Rows of `alive` with each filter that would remove them next."""
    after = F.array_compact(F.array(*[F.when(F.col("gone").bitwiseAND(1 << i) == 0, F.lit(f)) for i, f in enumerate(filters)]))
    return alive.withColumn("filter", F.explode(after)).join(fails, ["row", "filter"], "left_semi")


def audit(rows: DataFrame, fails: DataFrame, classes: dict[str, DataFrame], filters: str = FILTERS) -> DataFrame:
    """One row per part, order of all filters and step, zeros included.

    rows: (row, doc_id, part) of every document, row unique. fails: (row, filter). classes: tables of doc_id,
    by name; each adds a column `<name>_lost`. Repeated or NULL ids in them count once or never. The work
    is at most n * 2^(n - 1) short rows a failing document. No documents give no rows.
    """
    failing = rows.join(fails, "row", "left_semi").select("row", "doc_id", "part", F.lit("").alias("class"))
    members = failing
    for name, ids in classes.items():
        members = members.union(failing.join(ids.select("doc_id"), "doc_id", "left_semi").select("row", "doc_id", "part", F.lit(name)))
    alive = stored(survivors(members.drop("doc_id"), fails, filters))

    def number(name):
        return F.count_if(F.col("class") == name)

    keys = ["part", "gone", "filter"]
    lost = [number(name).alias(f"{name}_lost") for name in classes]
    removed = stored(removals(alive, fails, filters).groupBy(keys).agg(number("").alias("removed"), *lost))
    left = alive.groupBy("part", "gone").agg(number("").alias("left"))
    fallen = failing.groupBy("part").agg(F.count("*").alias("fallen"))
    parts = rows.groupBy("part").agg(F.count("*").alias("total")).join(fallen, "part", "left").na.fill(0, ["fallen"])

    every = ["".join(p) for p in itertools.permutations(filters)]
    grid = parts.select("*", F.explode(F.lit(every)).alias("filter_order")).select("*", F.explode(F.lit(list(range(1, len(filters) + 1)))).alias("step"))
    before = F.substring("filter_order", F.lit(1), F.col("step") - 1)
    gone = sum((F.when(before.contains(f), 1 << i).otherwise(0) for i, f in enumerate(filters)), F.lit(0))
    bit = sum((F.when(F.col("filter") == f, 1 << i).otherwise(0) for i, f in enumerate(filters)), F.lit(0))
    grid = grid.withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1))).withColumn("gone", gone).withColumn("then", F.col("gone") + bit)

    # Nothing is removed before the first filter, so its removals are all that fail; behind all others, those that fail nothing else.
    alone = (1 << len(filters)) - 1 - bit
    fails_of = removed.filter("gone = 0").select("part", "filter", F.col("removed").alias("failing"))
    unique = removed.filter(F.col("gone") == alone).select("part", "filter", F.col("removed").alias("unique_fails"))
    full = (
        grid.join(removed, keys, "left")
        .join(fails_of, ["part", "filter"], "left")
        .join(unique, ["part", "filter"], "left")
        .join(left.withColumnRenamed("gone", "then"), ["part", "then"], "left")
        .na.fill(0)
    )
    return full.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.col("fallen") + F.col("left")).alias("kept"),
        "removed",
        (F.col("failing") - F.col("removed")).alias("redundant"),
        "unique_fails",
        *[f"{name}_lost" for name in classes],
        F.sum("removed").over(Window.partitionBy("part", "filter")).alias("shapley"),
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`audit` of the filters A to E over documents (doc_id, text, lang), by lang.

    A NULL text is empty, a NULL lang the empty string. Rows may repeat: equal rows have one doc_id, so neither is
    the other's copy, and each counts. Labels of several rows count a document once. Other columns are ignored.
    """
    rows = measured(docs)
    classes = {"good": labels.filter("quality = 1"), "toxic": labels.filter("toxic = 1")}
    return audit(rows, failing_ids(rows), classes)
