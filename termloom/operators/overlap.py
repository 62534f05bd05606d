"""Greedy token matching where a token only matches itself."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T


def _counted(batches):
    """(key, words and matched words of each side) of rows in key order; a key may go on in the next batch.

    Bytes are split where Spark's ``\\s`` splits: at ASCII blanks.
    """
    key, sides, begun = None, (Counter(), Counter()), False
    kind = pa.null()

    def same(a, b) -> bool:
        return a == b or (a != a and b != b)

    def batch_of(rows):
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        kinds = (kind, *[pa.int64()] * 4)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            names=["key", "here", "hit_here", "there", "hit_there"],
        )

    def summed():
        here, there = sides
        both = here.keys() & there.keys()
        return key, here.total(), sum(here[w] for w in both), there.total(), sum(there[w] for w in both)

    for batch in batches:
        kind, rows = batch.column(0).type, []
        for own, *texts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            if begun and not same(own, key):
                rows.append(summed())
                sides = (Counter(), Counter())
            key, begun = own, True
            for words, text in zip(sides, texts, strict=True):
                words.update((text.as_py() or b"").split())
        yield batch_of(rows)
    if begun:
        yield batch_of([summed()])


def token_overlap_f1(df: DataFrame, key: str, prediction: str, reference: str) -> DataFrame:
    """Precision, recall and F1 per key: greedy matching over one-hot token vectors.

    Texts go to their key's partition and are sorted by key there; words are split and counted key by
    key and never become rows, so that what is shuffled, sorted and spilled are texts. A task holds the
    different words of one key. A key without words keeps its row.
    """
    rows = df.select(F.col(key).alias("key"), *(F.col(c).cast("string").cast("binary").alias(n) for c, n in ((prediction, "p"), (reference, "r"))))
    kind = rows.schema["key"].dataType
    counts = T.StructType([T.StructField("key", kind)] + [T.StructField(n, T.LongType()) for n in ("here", "hit_here", "there", "hit_there")])
    counted = rows.repartition("key").sortWithinPartitions("key").mapInArrow(_counted, counts)

    def share(side: str) -> Column:
        return F.coalesce(F.try_divide(F.col(f"hit_{side}").cast("double"), F.col(side)), F.lit(0.0))

    product = 2 * F.col("precision") * F.col("recall")
    return counted.select(
        F.col("key").alias(key), share("here").alias("precision"), share("there").alias("recall")
    ).withColumn(
        "f1",
        F.coalesce(F.try_divide(product, F.col("precision") + F.col("recall")), F.lit(0.0)),
    )
