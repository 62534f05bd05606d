"""Registered queries: one per operator, each over whole tables.

Nested results are flattened and doubles rounded, so that another engine's rows compare equal.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from termloom.functions import chat, lengths, questions, terms, tokens, validity
from termloom.functions.hashing import draw
from termloom.functions.similarity import greedy_match_f1
from termloom.operators import (
    choice,
    combine,
    compare,
    inference,
    ordering,
    overlap,
    pairs,
    position,
    profile,
    rank_index,
    recall,
    sampling,
    semantic,
)
from termloom.plans.standins import standin, table
from termloom.plans.training import compare_reports, training_pairs
from termloom.session import shared_folder
from termloom.schemas import RECALL_REPORT
from termloom.sources import runs
from termloom.sources.jsonl import json_lines, read_chat_jsonl, read_eval_samples, write_jsonl
from termloom.sources.reports import write_by_run
from termloom.sources.settings import latest_config
from termloom.sources.subjects import load_choice_items
from termloom.sources.vocab_csv import read_vocab_csv, write_vocab_csv

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIGITS = 6
TOP = 25
CAP = 50
TOKENS_PER_TEXT = 8
LISTED = ","


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standin(spark, sf_dir, "vocab")


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_pairs(_vocab(spark, sf_dir).drop("doc_id"))


def _as_eval(rows: DataFrame) -> DataFrame:
    return rows.select("sample_id", "question", F.col("response").alias("ground_truth"))


def _eval_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_eval(_pairs(spark, sf_dir))


def _indexed(
    spark: SparkSession, sf_dir: str, *draws: tuple[int, str]
) -> tuple[DataFrame, rank_index.RankIndex]:
    """Pairs, and the index of their draws as the job that writes pairs leaves it beside them."""
    rows = _pairs(spark, sf_dir)
    folder = _new_folder(spark, "rank")
    return rows, rank_index.build_rank_index(rows, "sample_id", folder, draws)


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _chat_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn right behind them."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter("role = 'user'").select(
        "conv_id", "turn", F.col("text").alias("question")
    )
    answered = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("ground_truth")
    )
    return asked.join(answered, ["conv_id", "turn"])


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recall.judged(standin(spark, sf_dir, "predictions"))


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return choice.choice_items(standin(spark, sf_dir, "choice_source"))


def _chosen(spark: SparkSession, sf_dir: str, response: str = "response") -> DataFrame:
    items = choice.usable_items(_items(spark, sf_dir))
    return choice.with_choice(items.withColumn("response", F.col(response)))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


def _long(df: DataFrame, *entries: tuple[str, str, str | None]) -> DataFrame:
    """One report row as (metric, value, passed) rows."""
    return df.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(name).alias("metric"),
                        F.round(F.col(value).cast("double"), DIGITS).alias("value"),
                        (F.col(passed) if passed else F.lit(None).cast("boolean")).alias("passed"),
                    )
                    for name, value, passed in entries
                )
            )
        )
    )


# --- vocabulary ---------------------------------------------------------------------------------


@query
def vocab_valid_rows(spark, sf_dir):
    return combine.require_fields(_vocab(spark, sf_dir)).select("doc_id", "Headword", "Meaning")


@query
def vocab_dedup(spark, sf_dir):
    return combine.drop_duplicates(_vocab(spark, sf_dir).drop("doc_id"))


@query
def vocab_duplicate_count(spark, sf_dir):
    return combine.count_duplicates(_vocab(spark, sf_dir).drop("doc_id"))


@query
def vocab_union(spark, sf_dir):
    """Source headers in one table, table names in another; neither has all columns."""
    rows = _vocab(spark, sf_dir)
    korean = {english: header for header, english in combine.VOCAB_HEADERS.items()}
    first = rows.select("doc_id", "Category", "Headword", "Meaning").withColumnsRenamed(korean)
    second = rows.select("doc_id", "Headword", "Abbreviation", "Source")
    return combine.union_all_by_name(combine.rename_vocab(first), combine.rename_vocab(second))


@query
def na_tokens_to_null(spark, sf_dir):
    """Missing-value spellings in every text column."""
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.expr("case when n_chars % 3 = 0 then 'NA' when n_chars % 3 = 1 then 'null' else lang end")
        .alias("lang"),
        "text",
    )
    return validity.na_to_null(rows)


def _answer_query(name: str, build) -> None:
    def run(spark, sf_dir):
        return pairs.keyed_terms(_vocab(spark, sf_dir)).select(
            "doc_id", build(pairs.row_fields()).alias("text")
        )

    QUERIES[name] = run


for _build in (
    terms.term_variants,
    terms.brief_meaning,
    terms.full_response,
    terms.category_response,
    terms.classification_response,
    terms.characteristics_response,
    terms.abbreviation_response,
    terms.mechanism_response,
    terms.extraction_context,
    terms.extraction_response,
):
    _answer_query(_build.__name__, _build)


@query
def available_types(spark, sf_dir):
    conditions = questions.type_conditions(pairs.row_fields())
    return pairs.keyed_terms(_vocab(spark, sf_dir)).select(
        "doc_id", F.explode(questions.available_types(conditions)).alias("type")
    )


@query
def picked_types(spark, sf_dir):
    terms_ = pairs.keyed_terms(_vocab(spark, sf_dir))
    return pairs.explode_types(terms_).select("doc_id", "row_key", "type")


@query
def picked_templates(spark, sf_dir):
    picked = pairs.explode_types(pairs.keyed_terms(_vocab(spark, sf_dir)))
    index = questions.template_index(F.col("type"), F.col("row_key"), pairs.SEED)
    return picked.select("doc_id", "type", index.alias("template"))


@query
def qa_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir)


@query
def qa_type_counts(spark, sf_dir):
    return pairs.count_by_type(_pairs(spark, sf_dir))


@query
def qa_skipped(spark, sf_dir):
    return pairs.count_skipped(combine.drop_duplicates(_vocab(spark, sf_dir).drop("doc_id")))


# --- chats --------------------------------------------------------------------------------------


@query
def chat_messages(spark, sf_dir):
    chats = pairs.with_messages(_pairs(spark, sf_dir))
    return chats.select("sample_id", F.posexplode("messages").alias("place", "message")).select(
        "sample_id", "place", "message.role", "message.content"
    )


@query
def chat_json_lines(spark, sf_dir):
    """The lines a chat file holds."""
    return json_lines(pairs.with_messages(_pairs(spark, sf_dir)).select("messages"))


@query
def chat_rendered(spark, sf_dir):
    chats = pairs.with_messages(_pairs(spark, sf_dir))
    return chats.select("sample_id", chat.render_chat(F.col("messages")).alias("text"))


@query
def prompts_rendered(spark, sf_dir):
    return _chat_pairs(spark, sf_dir).select(
        "conv_id", "turn", chat.render_prompt(F.col("question")).alias("prompt")
    )


@query
def response_spans(spark, sf_dir):
    rows = _chat_pairs(spark, sf_dir)
    text = chat.render_pair(F.col("question"), F.col("ground_truth"))
    return rows.select("conv_id", "turn", chat.response_spans(text).alias("s")).select(
        "conv_id",
        "turn",
        "s.prompt",
        F.array_join("s.responses", LISTED).alias("response"),
        F.round("s.response_share", DIGITS).alias("response_share"),
    )


@query
def eval_from_messages(spark, sf_dir):
    rows = _chat_pairs(spark, sf_dir)
    stored = rows.select(
        "conv_id", "turn", chat.to_messages(F.col("question"), F.col("ground_truth")).alias("m")
    )
    return stored.select("conv_id", "turn", *chat.messages_to_eval(F.col("m")))


@query
def previews(spark, sf_dir):
    """First 200 characters of each answer, as shown for a look at the data."""
    return _pairs(spark, sf_dir).select(
        "sample_id", chat.preview(F.col("response")).alias("preview")
    )


# --- samples ------------------------------------------------------------------------------------


@query
def sample_ids(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("text")
    return sampling.with_sample_id(rows)


@query
def holdout_sample(spark, sf_dir):
    rows, index = _indexed(spark, sf_dir, (sampling.SAMPLE_SEED, "holdout"))
    return sampling.exact_fraction(_as_eval(rows), "sample_id", index=index)


@query
def train_eval_split(spark, sf_dir):
    _, index = _indexed(spark, sf_dir, (sampling.SPLIT_SEED, "split"))
    return sampling.label_split(index.keys, "sample_id", index=index)


@query
def cap_rows(spark, sf_dir):
    return sampling.cap_rows(_eval_rows(spark, sf_dir), "sample_id", CAP)


@query
def validation_sample(spark, sf_dir):
    rows = _chat_pairs(spark, sf_dir).withColumn("key", F.concat_ws("-", "conv_id", "turn"))
    return sampling.sample_validation(rows, "key").drop("key")


@query
def shuffled_rank(spark, sf_dir):
    _, index = _indexed(spark, sf_dir, (sampling.SAMPLE_SEED, "shuffle"))
    return index.position(index.keys, sampling.SAMPLE_SEED, "shuffle", "position")


@query
def shuffled_chats(spark, sf_dir):
    """The rows of the shuffled training file."""
    rows = sampling.with_draw(_pairs(spark, sf_dir), "sample_id", pairs.SEED, "shuffle")
    return ordering.shuffle_rows(rows, "drawn").select("drawn", "question", "response")


@query
def head_rows(spark, sf_dir):
    rows = sampling.with_draw(_pairs(spark, sf_dir), "sample_id", pairs.SEED, "shuffle")
    return ordering.head(rows, F.col("drawn")).select("sample_id", "question")


@query
def train_without_holdout(spark, sf_dir):
    rows = _eval_rows(spark, sf_dir)
    held = sampling.exact_fraction(rows, "sample_id")
    return sampling.exclude_holdout(rows, held, "sample_id").select("sample_id", "question")


@query
def train_without_labelled(spark, sf_dir):
    """A hold-out that comes from another table."""
    rows = standin(spark, sf_dir, "predictions").select("sample_id", "question")
    held = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("sample_id"))
    return sampling.exclude_holdout(rows, held, "sample_id")


@query
def leakage_report(spark, sf_dir):
    rows, index = _indexed(spark, sf_dir, (sampling.SAMPLE_SEED, "holdout"))
    marked = sampling.mark_fraction(_as_eval(rows), "sample_id", index=index)
    return sampling.leakage_within(marked, F.col("held"))


@query
def leakage_between_tables(spark, sf_dir):
    """Labelled documents as training rows, the others as evaluation rows."""
    rows = standin(spark, sf_dir, "predictions")
    labelled = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("sample_id"))
    return sampling.leakage_report(
        rows.join(labelled, "sample_id", "left_semi"), rows.join(labelled, "sample_id", "left_anti")
    )


@query
def stratified_sample(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return sampling.stratified_sample(rows, "lang", "doc_id")


@query
def requested_minus_found(spark, sf_dir):
    requested = table(spark, sf_dir, "documents")
    return sampling.requested_minus_found(requested, table(spark, sf_dir, "labels"), "doc_id")


@query
def top_scores(spark, sf_dir):
    rows = standin(spark, sf_dir, "predictions").select("sample_id", "score")
    return _rounded(ordering.top_scores(rows, "score", "sample_id", TOP), "score")


@query
def rank_scores(spark, sf_dir):
    rows = standin(spark, sf_dir, "predictions").select("sample_id", "score")
    ranked = ordering.rank_by(rows, "score", "sample_id", descending=True)
    return _rounded(ranked, "score")


# --- lengths and scores -------------------------------------------------------------------------


def _pair_lengths(spark, sf_dir):
    text = chat.render_pair(F.col("question"), F.col("response"))
    return _pairs(spark, sf_dir).select("sample_id", lengths.word_length(text).alias("length"))


def _document_lengths(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", lengths.word_length(F.col("text")).alias("length")
    )


@query
def token_lengths(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        lengths.word_length(F.col("text")).alias("words"),
        lengths.char_length(F.col("text")).alias("chars"),
    )


@query
def length_stats(spark, sf_dir):
    stats = profile.length_stats(_pair_lengths(spark, sf_dir))
    return _rounded(stats, "mean", "median", "p95", "p99").drop("recommended_max_seq_length")


@query
def recommended_length(spark, sf_dir):
    stats = profile.length_stats(_pair_lengths(spark, sf_dir))
    return stats.select("num_samples", "recommended_max_seq_length")


@query
def length_buckets(spark, sf_dir):
    bucket = lengths.round_to_bucket(F.col("length")).alias("bucket")
    counted = profile.length_histogram(_document_lengths(spark, sf_dir))
    return counted.groupBy(bucket).agg(F.sum("samples").alias("samples"))


@query
def over_limit(spark, sf_dir):
    rows = _document_lengths(spark, sf_dir)
    limit = profile.length_stats(rows).select("recommended_max_seq_length").scalar()
    return _rounded(profile.over_limit_share(rows, limit), "over_limit_percent")


@query
def score_summary(spark, sf_dir):
    summary = profile.score_summary(standin(spark, sf_dir, "predictions"))
    return _rounded(summary, "f1_mean", "f1_std")


@query
def score_histogram(spark, sf_dir):
    return _rounded(profile.histogram(standin(spark, sf_dir, "predictions")), "low", "high")


@query
def step_plan(spark, sf_dir):
    train, _ = sampling.train_eval_split(_pairs(spark, sf_dir), "sample_id")
    return profile.step_plan(train)


@query
def step_plan_without_evaluation(spark, sf_dir):
    return profile.step_plan(_pairs(spark, sf_dir), evaluated=False)


# --- recall -------------------------------------------------------------------------------------


@query
def aligned_predictions(spark, sf_dir):
    rows = standin(spark, sf_dir, "predictions")
    return recall.align_predictions(
        rows.select("sample_id", "prediction"), rows.select("sample_id", "ground_truth")
    )


@query
def unmatched_predictions(spark, sf_dir):
    """Documents as predictions, labels as truth: many documents have no label."""
    return recall.unmatched_predictions(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id"
    )


@query
def headword_hits(spark, sf_dir):
    return _judged(spark, sf_dir).select(
        "sample_id", "headword", "headword_hit", "abbreviation", "abbreviation_hit"
    )


def _accuracy_query(name: str, aggregate) -> None:
    def run(spark, sf_dir):
        metric = _judged(spark, sf_dir).agg(aggregate().alias("m")).select("m.*")
        return _rounded(metric, "accuracy")

    QUERIES[name] = run


_accuracy_query("headword_recall_lenient", lambda: recall.headword_accuracy("lenient"))
_accuracy_query("headword_recall_strict", lambda: recall.headword_accuracy("strict"))
_accuracy_query("abbreviation_match", recall.abbreviation_accuracy)


@query
def headword_counts(spark, sf_dir):
    return recall.headword_counts(_judged(spark, sf_dir))


@query
def recall_details(spark, sf_dir):
    rows = sampling.with_draw(_judged(spark, sf_dir), "sample_id", pairs.SEED, "index")
    return _rounded(recall.recall_details(ordering.row_index(rows, "drawn")), "bertscore_f1")


@query
def test1_report(spark, sf_dir):
    report = recall.recall_report(_judged(spark, sf_dir), "run")
    return _long(
        report,
        ("bertscore_f1_mean", "bertscore.f1_mean", "passed.bertscore"),
        ("bertscore_f1_std", "bertscore.f1_std", None),
        ("headword_recall", "headword_recall.accuracy", "passed.headword"),
        ("abbreviation_match", "abbreviation_match.accuracy", None),
        ("num_samples", "num_samples", "overall_passed"),
    )


@query
def validation_report(spark, sf_dir):
    report = recall.validation_report(recall.judged(standin(spark, sf_dir, "predictions")))
    report = report.drop("num_scored", "num_unscored")
    return _rounded(report, "bertscore_f1", "bertscore_std", "headword_recall")


def _partly_scored(spark, sf_dir):
    scored = F.when(F.col("sample_id") % 4 != 0, F.col("score"))
    return recall.judged(standin(spark, sf_dir, "predictions").withColumn("score", scored))


@query
def unscored_recall_report(spark, sf_dir):
    """A quarter of the answers has no semantic score: counted, and the gate fails."""
    return _long(
        recall.recall_report(_partly_scored(spark, sf_dir)),
        ("bertscore_f1_mean", "bertscore.f1_mean", "passed.bertscore"),
        ("num_scored", "num_scored", None),
        ("num_unscored", "num_unscored", "overall_passed"),
    )


@query
def unscored_validation_report(spark, sf_dir):
    report = recall.validation_report(_partly_scored(spark, sf_dir))
    return _rounded(report, "bertscore_f1", "bertscore_std", "headword_recall")


# --- multiple choice ----------------------------------------------------------------------------


@query
def mcq_items(spark, sf_dir):
    return _items(spark, sf_dir).select(
        "sample_id", "subject", "answer", F.array_join("choices", LISTED).alias("choices")
    )


@query
def mcq_rejected(spark, sf_dir):
    return choice.count_rejected(_items(spark, sf_dir))


@query
def mcq_prompts(spark, sf_dir):
    return _items(spark, sf_dir).select("sample_id", "prompt")


@query
def mcq_predictions(spark, sf_dir):
    return _chosen(spark, sf_dir).select("sample_id", "predicted", "correct")


@query
def mcq_accuracy(spark, sf_dir):
    return _rounded(choice.accuracy(_chosen(spark, sf_dir)), "accuracy")


@query
def mcq_correct_incorrect(spark, sf_dir):
    return choice.correct_incorrect(_chosen(spark, sf_dir))


@query
def mcq_details(spark, sf_dir):
    rows = sampling.with_draw(_chosen(spark, sf_dir), "sample_id", pairs.SEED, "index")
    details = choice.choice_details(ordering.row_index(rows, "drawn"))
    return details.withColumn("choices", F.array_join("choices", LISTED))


@query
def test2_report(spark, sf_dir):
    report = choice.choice_report(
        _chosen(spark, sf_dir), _chosen(spark, sf_dir, "base_response"), "run"
    )
    overall = _long(
        report,
        ("accuracy", "finetuned.accuracy", "passed.min_accuracy_met"),
        ("base_accuracy", "base.accuracy", None),
        ("performance_drop", "performance_drop", "passed.drop_acceptable"),
        ("total", "finetuned.total", "overall_passed"),
    )
    subjects = report.select(F.explode("finetuned.by_subject").alias("subject", "of")).select(
        F.concat(F.lit("subject "), "subject").alias("metric"),
        F.round("of.accuracy", DIGITS).alias("value"),
        F.lit(None).cast("boolean").alias("passed"),
    )
    return overall.unionAll(subjects)


# --- comparisons --------------------------------------------------------------------------------


@query
def variant_comparison(spark, sf_dir):
    metrics = (
        standin(spark, sf_dir, "variant_scores")
        .groupBy("variant", F.col("subject").alias("metric"))
        .agg(F.avg("correct").alias("value"))
    )
    compared = compare.compare_variants(metrics, "full", "quantised")
    return _rounded(compared, "first_value", "second_value", "drop")


def _compared(spark, sf_dir, second_score: Column) -> DataFrame:
    """Reports of two variants over their halves of the answers, compared and flattened."""

    def reports(rest: int, response: str, score: Column) -> tuple[DataFrame, DataFrame]:
        rows = standin(spark, sf_dir, "predictions").filter(F.col("sample_id") % 2 == rest)
        return (
            recall.recall_report(recall.judged(rows.withColumn("score", score)), "run"),
            choice.choice_report(_chosen(spark, sf_dir, response), None, "run"),
        )

    names = ("full", "quantised")
    report = compare_reports(
        reports(0, "response", F.col("score")), reports(1, "base_response", second_score), names
    )
    columns = [*names, "performance_drop"]
    lines = [
        F.struct(
            F.lit(metric).alias("metric"),
            *(F.round(f"{c}.{metric}", DIGITS).alias(c) for c in columns),
            F.col(f"passed.{flag}").alias("passed"),
        )
        for metric, flag in compare.FLAGS.items()
    ]
    overall = F.struct(
        F.lit("overall").alias("metric"),
        *(F.lit(None).cast("double").alias(c) for c in columns),
        F.col("overall_passed").alias("passed"),
    )
    return report.select(F.inline(F.array(*lines, overall)))


@query
def comparison_report(spark, sf_dir):
    return _compared(spark, sf_dir, F.col("score") * 0.9)


@query
def comparison_report_unscored(spark, sf_dir):
    """The second variant was never scored: its metric is missing and nothing passes over it."""
    return _compared(spark, sf_dir, F.lit(None).cast("double"))


@query
def base_comparison(spark, sf_dir):
    rows = standin(spark, sf_dir, "variant_scores").select(
        F.col("variant").alias("model"), (F.col("correct") == 1).alias("correct")
    )
    compared = compare.compare_base(rows, "full", "quantised")
    return _rounded(compared, "base_accuracy", "tuned_accuracy", "performance_drop")


@query
def unshared_samples(spark, sf_dir):
    rows = standin(spark, sf_dir, "variant_scores")
    return compare.unshared_samples(rows, "full", "quantised")


# --- batches and similarity ---------------------------------------------------------------------


def _prompt_batches(spark, sf_dir):
    rows = _chat_pairs(spark, sf_dir).select(
        "conv_id",
        "turn",
        F.transform(F.split("question", " "), lambda word: F.length(word)).alias("ids"),
    )
    key = F.concat_ws("-", "conv_id", "turn")
    return inference.assign_batches(
        rows.withColumn("drawn", draw(pairs.SEED, key, F.lit("batch"))),
        "drawn",
        inference.RECALL_BATCH,
    )


@query
def left_padded_batches(spark, sf_dir):
    """Word lengths of the prompts stand for token ids."""
    padded = inference.pad_batches(_prompt_batches(spark, sf_dir))
    return padded.select(
        "conv_id",
        "turn",
        "batch",
        "padded_length",
        F.array_join(F.col("input_ids").cast("array<string>"), LISTED).alias("input_ids"),
        F.array_join(F.col("attention_mask").cast("array<string>"), LISTED).alias("mask"),
    )


@query
def prompt_tokens(spark, sf_dir):
    """Ids cut to the prompt limit, and ids behind a prompt of four."""
    ids = F.transform(F.split("text", " "), lambda word: F.length(word))

    def added(column):
        return F.aggregate(column, F.lit(0).cast("bigint"), lambda n, x: n + x)

    return table(spark, sf_dir, "documents").select(
        "doc_id",
        added(tokens.truncate(ids)).alias("kept"),
        added(tokens.strip_prompt(ids, F.lit(4))).alias("generated"),
    )


def _counting_model():
    """Answers every prompt with its length."""
    return lambda prompts: [f" {len(prompt)} characters\n" for prompt in prompts]


@query
def batched_predictions(spark, sf_dir):
    rows = _chat_pairs(spark, sf_dir).select(
        "conv_id", "turn", chat.render_prompt(F.col("question")).alias("prompt")
    )
    return inference.predict_batches(rows, _counting_model).drop("prompt")


@query
def token_overlap_f1(spark, sf_dir):
    rows = standin(spark, sf_dir, "predictions")
    scored = overlap.token_overlap_f1(rows, "sample_id", "prediction", "ground_truth")
    return _rounded(scored, "precision", "recall", "f1")


def _word_angles():
    """An encoder: a word's length, modulo 8, picks one of eight directions in the plane."""
    turns = [(math.cos(i * math.pi / 16), math.sin(i * math.pi / 16)) for i in range(8)]

    def encode(texts):
        return [np.array([turns[len(w) % 8] for w in t.split(" ") if w]).reshape(-1, 2) for t in texts]

    return encode


@query
def semantic_scores(spark, sf_dir):
    """Whole answers against whole truths, under an encoder that SQL can follow."""
    rows = standin(spark, sf_dir, "predictions").select("sample_id", "prediction", "ground_truth")
    tasks = spark.sparkContext.defaultParallelism
    scored = semantic.semantic_scores(rows, _word_angles, tasks=tasks)
    return _rounded(scored.drop("prediction", "ground_truth"), "precision", "recall", "score")


@query
def embedding_match_f1(spark, sf_dir):
    """Eight consecutive vectors stand for the tokens of a text; texts meet their successors."""
    place = F.col("vec_id") % (2 * TOKENS_PER_TEXT)
    texts = (
        table(spark, sf_dir, "embeddings")
        .groupBy(F.expr(f"vec_id div {2 * TOKENS_PER_TEXT}").alias("text_pair"))
        .agg(
            F.collect_list(F.when(place < TOKENS_PER_TEXT, F.col("embedding"))).alias("predicted"),
            F.collect_list(F.when(place >= TOKENS_PER_TEXT, F.col("embedding"))).alias("reference"),
        )
    )
    scored = texts.select(
        "text_pair", greedy_match_f1(F.col("predicted"), F.col("reference")).alias("s")
    )
    return scored.select(
        "text_pair",
        *(F.round(f"s.{name}", 4).alias(name) for name in ("precision", "recall", "f1")),
    )


# --- settings -----------------------------------------------------------------------------------


@query
def latest_settings(spark, sf_dir):
    log = standin(spark, sf_dir, "settings_log")
    return latest_config(log, F.struct("ts", "event_id"))


# --- stored and read back -----------------------------------------------------------------------


#: Bytes of a stored list per file, before compression; a task writes one file.
FILE_BYTES = 64 << 20


@query
def paired_by_position(spark, sf_dir):
    """Two tables in files of their own cut, paired by place; the truths are fewer and end the pairing."""
    rows = standin(spark, sf_dir, "predictions")

    def stored(df: DataFrame, least: int) -> DataFrame:
        folder = _new_folder(spark, "lists")
        key, text = df.columns
        size = df.agg(F.sum(F.octet_length(text) + 8)).first()[0] or 0
        files = max(least, math.ceil(size / FILE_BYTES))
        df.repartitionByRange(files, F.col(key)).sortWithinPartitions(key).write.parquet(folder)
        return spark.read.parquet(folder)

    predictions = stored(rows.select(F.col("sample_id").alias("prediction_id"), "prediction"), 5)
    truths = stored(
        rows.filter("sample_id % 10 <> 9").select(F.col("sample_id").alias("truth_id"), "ground_truth"), 3
    )
    return position.align_by_position(predictions, truths)


@query
def vocab_file_round_trip(spark, sf_dir):
    """A vocabulary written as CSV and read with the rule for missing values."""
    folder = _new_folder(spark, "csv")
    write_vocab_csv(_vocab(spark, sf_dir).drop("doc_id"), folder)
    return read_vocab_csv(spark, folder)


@query
def chat_file_round_trip(spark, sf_dir):
    folder = _new_folder(spark, "chats")
    rows = _chat_pairs(spark, sf_dir)
    messages = chat.to_messages(F.col("question"), F.col("ground_truth")).alias("messages")
    write_jsonl(rows.select(messages), folder)
    return read_chat_jsonl(spark, folder).select(*chat.messages_to_eval(F.col("messages")))


@query
def eval_samples(spark, sf_dir):
    """An evaluation file read with the ids of its rows."""
    folder = _new_folder(spark, "eval")
    write_jsonl(standin(spark, sf_dir, "predictions").select("question", F.left("ground_truth", F.lit(40)).alias("ground_truth")), folder)
    return read_eval_samples(spark, folder)


@query
def report_round_trip(spark, sf_dir):
    """A committed report read back, after a later attempt of another run."""
    folder = _new_folder(spark, "runs")
    report = recall.recall_report(_judged(spark, sf_dir), "run", "now")
    for run in ("run", "other"):
        runs.write_run(folder, run, {"report": report}, "now", reports=("report",))
    return _long(
        runs.read_run(spark, folder, "run", "report", RECALL_REPORT),
        ("bertscore_f1_mean", "bertscore.f1_mean", "passed.bertscore"),
        ("headword_recall", "headword_recall.accuracy", "passed.headword"),
        ("num_samples", "num_samples", "overall_passed"),
    )


@query
def details_by_run(spark, sf_dir):
    """Rows of two runs side by side, read by run."""
    folder = _new_folder(spark, "details")
    rows = _judged(spark, sf_dir).select("sample_id", "headword", "headword_hit")
    write_by_run(rows, folder, "first")
    write_by_run(rows.filter("headword_hit"), folder, "second")
    return spark.read.parquet(folder).filter("run_name = 'second'")


def _subject_folder(spark, sf_dir) -> str:
    folder = _new_folder(spark, "subjects")
    items = standin(spark, sf_dir, "choice_source").select("subject", "question", "A", "B", "C", "D", "answer")
    items.write.partitionBy("subject").parquet(folder)
    return folder


SUBJECTS = ("de", "en", "xx")


@query
def subject_items(spark, sf_dir):
    """All items of two subjects of a stored benchmark; a third one has no folder."""
    found = load_choice_items(spark, _subject_folder(spark, sf_dir), SUBJECTS, per_subject=1 << 40)
    return found.items.select("subject", "question", "answer", F.array_join("choices", LISTED).alias("choices"))


@query
def subject_warnings(spark, sf_dir):
    found = load_choice_items(spark, _subject_folder(spark, sf_dir), SUBJECTS)
    rejected = load_choice_items(spark, _subject_folder(spark, sf_dir), SUBJECTS, per_subject=1 << 40).rejected
    return found.warnings.unionAll(
        rejected.select("subject", F.concat(F.col("rejected").cast("string"), F.lit(" rejected")).alias("reason"))
    )


# --- batches by length --------------------------------------------------------------------------


def _length_batches(spark, sf_dir):
    rows = _chat_pairs(spark, sf_dir).select(
        "conv_id",
        "turn",
        "question",
        F.transform(F.split("question", " "), lambda word: F.length(word)).alias("ids"),
    )
    key = F.concat_ws("-", "conv_id", "turn")
    rows = rows.withColumn("drawn", draw(pairs.SEED, key, F.lit("batch"))).withColumn("length", F.size("ids"))
    return inference.assign_batches_by_length(rows, "length", "drawn", inference.RECALL_BATCH)


@query
def length_batches(spark, sf_dir):
    padded = inference.pad_batches(_length_batches(spark, sf_dir))
    return padded.select("conv_id", "turn", "length", "batch", "padded_length")


@query
def padding_shares(spark, sf_dir):
    """Padding of batches in the order of the draws, and in that of the lengths."""
    drawn = inference.padding_share(_prompt_batches(spark, sf_dir)).withColumn("batches", F.lit("by draw"))
    sorted_ = inference.padding_share(_length_batches(spark, sf_dir)).withColumn("batches", F.lit("by length"))
    return _rounded(drawn.unionAll(sorted_), "padding")


def _size_telling_model():
    """Answers every prompt with its length and that of the batch it came in."""
    return lambda prompts, max_new_tokens: [
        f" {len(p)} of {sum(map(len, prompts))}, at most {max_new_tokens}" for p in prompts
    ]


@query
def planned_predictions(spark, sf_dir):
    """The model gets exactly the batches planned by length."""
    rows = _length_batches(spark, sf_dir).select("conv_id", "turn", "batch", F.col("question").alias("prompt"))
    settings = inference.RECALL
    found = inference.predict_planned(
        rows, _size_telling_model, max_new_tokens=settings.max_new_tokens, tasks=spark.sparkContext.defaultParallelism
    )
    return found.drop("prompt")
