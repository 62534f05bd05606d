"""The three jobs: vocabulary to training chats, training chats to lengths and samples, and
answers to reports. Each stage writes Parquet that the next one reads by column."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from termloom.functions import lengths as length_functions
from termloom.functions.chat import messages_to_eval, render_pair, to_messages
from termloom.functions.hashing import draw
from termloom.operators import choice, compare, inference, profile, recall, sampling
from termloom.operators.combine import drop_duplicates, rename_vocab, with_row_key
from termloom.operators.ordering import cut_point, row_index, shuffle_rows, up_to
from termloom.operators.pairs import count_by_type, qa_pairs
from termloom.sources.jsonl import write_jsonl

SHUFFLE_SALT = "shuffle"


def training_pairs(vocab: DataFrame, seed: int = sampling.SAMPLE_SEED) -> DataFrame:
    """Deduplicated rows to pairs: one shuffle, for the deduplication.

    Keys are made in front of it, so plans that read its output several times do not repeat them.
    """
    return qa_pairs(drop_duplicates(with_row_key(rename_vocab(vocab))), seed)


def shuffled_chats(pairs: DataFrame, seed: int = sampling.SAMPLE_SEED) -> DataFrame:
    """``messages`` in seeded random order."""
    chats = pairs.select(
        draw(seed, F.col("sample_id"), F.lit(SHUFFLE_SALT)).alias("drawn"),
        to_messages(F.col("question"), F.col("response")).alias("messages"),
    )
    return shuffle_rows(chats, "drawn").select("messages")


def build_training_data(
    vocab: DataFrame, pairs_path: str, chats_path: str, seed: int = sampling.SAMPLE_SEED
) -> DataFrame:
    """Writes the pairs (Parquet) and the shuffled chats (JSON lines); returns counts by type.

    The pairs are built once; chats and counts are read back from the written table.
    """
    spark = vocab.sparkSession
    training_pairs(vocab, seed).write.mode("overwrite").parquet(pairs_path)
    pairs = spark.read.parquet(pairs_path)
    write_jsonl(shuffled_chats(pairs, seed), chats_path, mode="overwrite")
    return count_by_type(pairs)


def pairs_from_chats(chats: DataFrame) -> DataFrame:
    """Stored chats (``messages``) as keyed pairs. Repeated chats stay separate rows.

    Keys come from a grouping of all texts, so write the result before preparing it.
    """
    texts = chats.select(*messages_to_eval(F.col("messages")))
    return sampling.with_sample_id(texts).withColumnRenamed("ground_truth", "response")


@dataclass
class Prepared:
    """What the preparation of training data yields."""

    stats: dict | None
    max_seq_length: int
    num_samples: int
    holdout: DataFrame
    train: DataFrame


def prepare(
    pairs: DataFrame,
    measure: Callable[[Column], Column] = length_functions.word_length,
    test_ratio: float = sampling.TEST_RATIO,
    max_seq_length: int | None = None,
    skip_analysis: bool = False,
    mode: str = "disjoint",
    seed: int = sampling.SAMPLE_SEED,
) -> Prepared:
    """Length profile and exact hold-out of stored pairs.

    The hold-out is a comparison with one cut, found once and shared by both parts, so taking it
    out of the training rows needs no join. ``mode='reference'`` leaves it in.
    """
    text = render_pair(F.col("question"), F.col("response"))
    stats = None
    if skip_analysis:
        count = pairs.count()
        limit = max_seq_length or length_functions.MAX_SEQUENCE
    else:
        stats = profile.length_stats(pairs.select(measure(text).alias("length"))).first().asDict()
        count = stats["num_samples"]
        limit = max_seq_length or stats["recommended_max_seq_length"]

    drawn = sampling.with_draw(pairs, "sample_id", seed, "holdout")
    cut = cut_point(drawn, "drawn", sampling.fraction_size(test_ratio)).first()
    cut = F.lit(cut["cut"] if cut else None)
    held = up_to(drawn, "drawn", cut).select(
        "sample_id",
        *messages_to_eval(to_messages(F.col("question"), F.col("response"))),
    )
    if mode == "reference":
        train = pairs
    elif mode == "disjoint":
        train = drawn.filter(F.coalesce(F.col("drawn") > cut, F.lit(True))).drop("drawn")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return Prepared(stats, limit, count, held, train)


def answer(
    samples: DataFrame,
    load_model: Callable[[], inference.Predict],
    prompt: Column,
    path: str,
    output: str = "prediction",
    batch_size: int = inference.GENERIC_BATCH,
) -> DataFrame:
    """Answers of a model, written to ``path`` once and read back.

    Reports and details are separate jobs; over unwritten answers each would ask the model again.
    """
    inference.predict_batches(
        samples.withColumn("_prompt", prompt), load_model, "_prompt", output, batch_size
    ).drop("_prompt").write.mode("overwrite").parquet(path)
    return samples.sparkSession.read.parquet(path)


def evaluate_recall(
    predicted: DataFrame, run_name: str | None = None, timestamp: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Report and details from rows with prediction, ground truth and semantic ``score``."""
    rows = recall.judged(predicted)
    ordered = row_index(sampling.with_draw(rows, "sample_id", sampling.SAMPLE_SEED, "index"), "drawn")
    return recall.recall_report(rows, run_name, timestamp), recall.recall_details(ordered)


def evaluate_choice(
    tuned: DataFrame,
    base: DataFrame | None = None,
    run_name: str | None = None,
    timestamp: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Report and details from usable items with a ``response``."""
    rows = choice.with_choice(tuned)
    reference = None if base is None else choice.with_choice(base)
    ordered = row_index(sampling.with_draw(rows, "sample_id", sampling.SAMPLE_SEED, "index"), "drawn")
    return (
        choice.choice_report(rows, reference, run_name, timestamp),
        choice.choice_details(ordered),
    )


def compare_reports(
    first: tuple[DataFrame, DataFrame],
    second: tuple[DataFrame, DataFrame],
    names: tuple[str, str] = ("fp16", "gguf"),
    run_name: str | None = None,
    timestamp: str | None = None,
) -> DataFrame:
    """Comparison report of two variants from their (recall, choice) reports."""
    metrics = compare.variant_metrics(*first, names[0]).unionAll(
        compare.variant_metrics(*second, names[1])
    )
    return compare.comparison_report(
        compare.compare_variants(metrics, *names), *names, run_name, timestamp
    )


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
