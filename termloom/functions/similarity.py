"""Greedy matching of token vectors (Zhang et al. 2020, "BERTScore")."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

SCORE = "precision double, recall double, f1 double"

# Tokens of a side of one tile: a tile of cosines takes 8 MB, whatever the texts' lengths.
TILE = 1024


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; a zero vector stays zero."""
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def _rows(tokens: pa.ListScalar) -> np.ndarray | None:
    """Token vectors of one text."""
    vectors = tokens.values
    if vectors is None or len(vectors) == 0:
        return None
    rows = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return rows.reshape(len(vectors), -1)


def best_cosines(left: np.ndarray, right: np.ndarray, tile: int = TILE) -> tuple[np.ndarray, np.ndarray]:
    """Best cosine of each row of ``left`` on the right, and of each row of ``right`` on the left.

    Cosines are made tile by tile; only the running best of rows and columns outlive a tile.
    """
    by_row, by_column = np.full(len(left), -np.inf), np.full(len(right), -np.inf)
    for i in range(0, len(left), tile):
        for j in range(0, len(right), tile):
            cosine = left[i : i + tile] @ right[j : j + tile].T
            rows, columns = by_row[i : i + tile], by_column[j : j + tile]
            np.maximum(rows, cosine.max(axis=1), out=rows)
            np.maximum(columns, cosine.max(axis=0), out=columns)
    return by_row, by_column


def match_scores(predicted: np.ndarray | None, reference: np.ndarray | None) -> dict[str, float]:
    """Precision, recall and F1 of two texts' token vectors; 0 where a text has no token."""
    if predicted is None or reference is None or not len(predicted) or not len(reference):
        return {"precision": 0.0, "recall": 0.0, "f1": 0.0}
    by_row, by_column = best_cosines(unit_rows(predicted), unit_rows(reference))
    precision, recall = by_row.mean(), by_column.mean()
    both = precision + recall
    f1 = 2 * precision * recall / both if both else 0.0
    return {"precision": float(precision), "recall": float(recall), "f1": float(f1)}


def greedy_match_f1(predicted: Column, reference: Column) -> Column:
    """Struct of precision, recall and F1 for two array<array<float>> columns.

    Each token takes its best cosine on the other side; Arrow hands the vectors over without
    per-value conversion.
    """

    @F.arrow_udf(SCORE)
    def score(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array(
            [match_scores(_rows(p), _rows(r)) for p, r in zip(left, right)],
            type=pa.struct([(n, pa.float64()) for n in ("precision", "recall", "f1")]),
        )

    return score(predicted, reference)
