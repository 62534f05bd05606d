"""New vocabulary files to chat samples, file by file as they arrive.

Rows need no other row to become pairs, so the batch expressions run on a stream unchanged and
without state. Repeated rows give pairs with the same ``sample_id``; removing them is left to the
batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from termloom.functions.chat import to_messages
from termloom.functions.validity import na_to_null
from termloom.operators.pairs import SEED, count_by_type, count_skipped, qa_pairs
from termloom.schemas import VOCAB
from termloom.sources.runs import commit_run, latest, start_attempt


def vocab_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return na_to_null(
        spark.readStream.schema(VOCAB)
        .options(
            header=True,
            escape='"',
            multiLine=True,
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
            maxFilesPerTrigger=files_per_batch,
        )
        .csv(path)
    )


def chats_from_stream(rows: DataFrame, seed: int = SEED) -> DataFrame:
    return qa_pairs(rows, seed).select(
        "sample_id", "type", to_messages(F.col("question"), F.col("response")).alias("messages")
    )


def write_available(chats: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Takes what has arrived since the last run, then stops."""
    return (
        chats.writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_counted(
    rows: DataFrame, folder: str, checkpoint: str, seed: int = SEED
) -> StreamingQuery:
    """Takes what has arrived since the last run, with the counts of each batch: rows, skipped rows, pairs, pairs by type.

    A batch is committed as a run named after its number, chats and counts together. A batch that is
    delivered again, as after a failure, finds itself committed and changes nothing; one that broke before its
    commit left nothing that readers see.
    """

    def take(batch: DataFrame, number: int) -> None:
        spark, run = batch.sparkSession, f"batch-{number}"
        if not latest(spark, folder).filter(F.col("run") == run).isEmpty():
            return
        attempt = start_attempt(folder, run)
        batch.write.parquet(f"{attempt}/rows")
        stored = spark.read.schema(batch.schema).parquet(f"{attempt}/rows")
        chats_from_stream(stored, seed).write.parquet(f"{attempt}/chats")
        chats = spark.read.parquet(f"{attempt}/chats")
        totals = count_skipped(stored)
        lines = [
            F.struct(F.lit(n).alias("count"), F.lit(None).cast("int").alias("type"), F.col(n).cast("bigint").alias("value"))
            for n in totals.columns
        ]
        by_type = count_by_type(chats).select(F.lit("pairs of type").alias("count"), "type", F.col("samples").alias("value"))
        counts = totals.select(F.inline(F.array(*lines))).unionAll(by_type).withColumn("batch", F.lit(number).cast("bigint"))
        counts.coalesce(1).write.parquet(f"{attempt}/counts")
        commit_run(spark, folder, run, attempt, {"chats": "parquet", "counts": "parquet"})

    return (
        rows.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def committed(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """``chats`` or ``counts`` of all committed batches; None before the first."""
    attempts = [row.attempt for row in latest(spark, folder).collect()]  # one row a batch
    return spark.read.parquet(*(f"{attempt}/{name}" for attempt in attempts)) if attempts else None
