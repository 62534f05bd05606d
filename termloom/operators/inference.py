"""Batches of prompts through a model function the user supplies."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from termloom.functions import tokens
from termloom.operators.ordering import row_index
from termloom.workers import per_worker


@dataclass(frozen=True)
class Generation:
    """How a model is asked: prompts at a time, and new tokens an answer may have."""

    batch_size: int
    max_new_tokens: int | None = None


# Leading digits of a draw that split the rows of one length.
HEAD_DIGITS = 2

# The settings of each use.
GENERIC = Generation(8, 256)
RECALL = Generation(16, 256)
CHOICE = Generation(32, 16)
VALIDATION = Generation(1, 128)

GENERIC_BATCH = GENERIC.batch_size
RECALL_BATCH = RECALL.batch_size

#: A list of prompts to as many answers; with a limit, it takes ``max_new_tokens`` as well.
Predict = Callable[..., Sequence[str]]


def assign_batches(
    df: DataFrame, drawn: str, batch_size: int = GENERIC_BATCH, name: str = "batch"
) -> DataFrame:
    """Consecutive batches in the order of the draws."""
    return row_index(df, drawn, name="_index").select(
        *df.columns, F.expr(f"_index div {batch_size}").alias(name)
    )


def assign_batches_by_length(
    df: DataFrame, length: str, drawn: str, batch_size: int = GENERIC_BATCH, name: str = "batch"
) -> DataFrame:
    """Consecutive batches in the order of length, then of the draws, so that a batch needs little padding.

    Rows are counted per length and leading digits of the draw. A row's place is the number of rows in the
    groups before its own, and its rank there, so a length that very many prompts share is ranked in parts.
    Lengths are few: the window over them sees one counter each.
    """
    headed = df.withColumn("_head", F.substring(drawn, 1, HEAD_DIGITS)).withColumn("_length", F.col(length))
    counted = headed.groupBy("_length", "_head").agg(F.count("*").alias("_rows"))

    def before(order: str, *groups: str):
        running = Window.partitionBy(*groups).orderBy(order)
        return F.coalesce(F.sum("_rows").over(running.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    lengths = counted.groupBy("_length").agg(F.sum("_rows").alias("_rows"))
    shorter = lengths.select(F.col("_length").alias("_of"), before("_length").alias("_shorter"))
    offsets = (
        counted.withColumn("_before", before("_head", "_length"))
        .join(shorter, F.col("_length").eqNullSafe(F.col("_of")))
        .select("_of", F.col("_head").alias("_group"), (F.col("_before") + F.col("_shorter")).alias("_offset"))
    )
    within = Window.partitionBy("_length", "_head").orderBy(drawn)
    ranked = headed.withColumn("_rank", F.row_number().over(within) - 1)
    same = F.col("_length").eqNullSafe(F.col("_of")) & (F.col("_head") == F.col("_group"))
    return ranked.join(offsets, same).select(
        *(F.col(f"`{c}`") for c in df.columns), F.expr(f"(_offset + _rank) div {batch_size}").alias(name)
    )


def padding_share(padded: DataFrame, batch: str = "batch", ids: str = "ids") -> DataFrame:
    """One row: tokens, places of the padded batches, and the share of places that padding takes."""
    per_batch = padded.groupBy(batch).agg(
        F.sum(F.size(ids)).alias("tokens"), (F.max(F.size(ids)) * F.count("*")).alias("places")
    )
    tokens_, places = F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("places"), F.lit(0))
    return per_batch.agg(tokens_.alias("tokens"), places.alias("places")).withColumn(
        "padding", F.coalesce(F.try_divide((F.col("places") - F.col("tokens")).cast("double"), "places"), F.lit(0.0))
    )


def pad_batches(
    df: DataFrame, batch: str = "batch", ids: str = "ids", pad_id: int = 0
) -> DataFrame:
    """Left padding to the longest ids of each batch, with the 0/1 mask beside it."""
    width = F.max(F.size(ids)).over(Window.partitionBy(batch))
    return (
        df.withColumn("padded_length", width)
        .withColumn("input_ids", tokens.left_pad(F.col(ids), F.col("padded_length"), pad_id))
        .withColumn("attention_mask", tokens.attention_mask(F.col(ids), F.col("padded_length")))
    )


def predict_batches(
    df: DataFrame,
    load_model: Callable[[], Predict],
    prompt: str = "prompt",
    output: str = "prediction",
    batch_size: int = GENERIC_BATCH,
    max_new_tokens: int | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Adds the model's stripped answer to every row.

    ``load_model()`` runs once per worker and returns a function from a list of prompts to as many
    answers; with ``max_new_tokens`` that function gets the limit by this name. Rows keep their
    columns, so answers need no alignment afterwards. ``tasks`` spreads the rows first, so that a slow model
    runs on all workers.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(output, T.StringType())])
    model = per_worker(load_model)
    limits = {} if max_new_tokens is None else {"max_new_tokens": max_new_tokens}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            predict = model()
            prompts, answers = rows.column(prompt).to_pylist(), []
            for start in range(0, len(prompts), batch_size):
                asked = prompts[start : start + batch_size]
                given = list(predict(asked, **limits))
                if len(given) != len(asked):
                    raise ValueError(f"{len(asked)} prompts, but {len(given)} answers")
                answers.extend(text and text.strip() for text in given)
            yield rows.append_column(output, pa.array(answers, pa.string()))

    return (df.repartition(tasks) if tasks else df).mapInArrow(run, schema)


def predict_planned(
    df: DataFrame,
    load_model: Callable[[], Predict],
    prompt: str = "prompt",
    output: str = "prediction",
    batch: str = "batch",
    max_new_tokens: int | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """As ``predict_batches``, but asks the model for exactly the batches that column ``batch`` plans.

    Batches are spread over tasks and taken whole, also where Arrow cuts through them. Rows keep their
    columns; their order is that of the batches, so a caller sorts by its own key.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(output, T.StringType())])
    model = per_worker(load_model)
    limits = {} if max_new_tokens is None else {"max_new_tokens": max_new_tokens}

    def answered(rows: pa.Table) -> pa.RecordBatch:
        prompts = rows.column(prompt).to_pylist()
        given = list(model()(prompts, **limits))
        if len(given) != len(prompts):
            raise ValueError(f"{len(prompts)} prompts, but {len(given)} answers")
        stripped = pa.array([text and text.strip() for text in given], pa.string())
        return rows.append_column(output, stripped).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for rows in batches:
            table = pa.Table.from_batches([rows])
            held = table if held is None else pa.concat_tables([held, table])
            names = held.column(batch).to_pylist()
            first = 0
            for place in range(1, len(names)):
                if names[place] != names[first]:
                    yield answered(held.slice(first, place - first))
                    first = place
            held = held.slice(first)
        if held is not None and held.num_rows:
            yield answered(held)

    dealt = df.repartition(tasks, batch) if tasks else df.repartition(batch)
    return dealt.sortWithinPartitions(batch).mapInArrow(run, schema)
