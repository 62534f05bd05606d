"""Answers to semantic scores, with an encoder the user supplies."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from termloom.functions.similarity import match_scores
from termloom.workers import per_worker

# Texts an encoder gets at a time.
ENCODER_BATCH = 64

#: Texts to one array of token vectors each, or None for a text that cannot be encoded.
Encode = Callable[[list[str]], Sequence[np.ndarray | None]]


def semantic_scores(
    df: DataFrame,
    load_encoder: Callable[[], Encode],
    prediction: str = "prediction",
    reference: str = "ground_truth",
    batch_size: int = ENCODER_BATCH,
    tasks: int | None = None,
) -> DataFrame:
    """Adds ``precision``, ``recall`` and ``score`` (F1) of greedy matching to every row.

    ``load_encoder()`` runs once per worker. A batch's texts are encoded once each, whole, and only
    one batch's vectors are held; a NULL text is empty. Rows with a text that the encoder gives no
    vectors for stay unscored (NULL). ``tasks`` spreads the rows first: a slow encoder wants more tasks
    than the bytes of the texts would give.
    """
    added = ["precision", "recall", "score"]
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, T.DoubleType()) for n in added)])
    encoder = per_worker(load_encoder)

    def scored(encode: Encode, left: list[str], right: list[str]) -> Iterator[tuple]:
        texts = list(dict.fromkeys([*left, *right]))
        given = list(encode(texts))
        if len(given) != len(texts):
            raise ValueError(f"{len(texts)} texts, but vectors of {len(given)}")
        vectors = {t: v if v is None else np.asarray(v, np.float64) for t, v in zip(texts, given, strict=True)}
        for one, other in zip(left, right, strict=True):
            if vectors[one] is None or vectors[other] is None:
                yield None, None, None
            else:
                found = match_scores(vectors[one], vectors[other])
                yield found["precision"], found["recall"], found["f1"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            encode = encoder()
            for start in range(0, rows.num_rows, batch_size):
                part = rows.slice(start, batch_size)
                sides = [[t or "" for t in part.column(c).to_pylist()] for c in (prediction, reference)]
                values = list(zip(*scored(encode, *sides), strict=True))
                arrays = [pa.array(v, pa.float64()) for v in values]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], names=[*part.schema.names, *added])

    return (df.repartition(tasks) if tasks else df).mapInArrow(run, schema)
