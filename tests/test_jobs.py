"""Whole jobs, the stream, and the shape of physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from termloom.functions.chat import render_prompt
from termloom.operators import choice, combine, pairs, sampling
from termloom.plans import training
from termloom.plans.standins import standin
from termloom.sources import jsonl, vocab_csv
from termloom.streaming import feed

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocab(spark):
    return standin(spark, SF_DIR, "vocab").drop("doc_id")


@pytest.fixture(scope="module")
def stored(spark, vocab, tmp_path_factory):
    """Deduplicated vocabulary and its pairs as tables."""
    root = tmp_path_factory.mktemp("stored")
    combine.drop_duplicates(vocab).write.parquet(f"{root}/vocab")
    table = spark.read.parquet(f"{root}/vocab")
    counts = training.build_training_data(vocab, f"{root}/pairs", f"{root}/chats")
    return table, training.read_pairs(spark, f"{root}/pairs"), f"{root}/chats", counts


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_training_data(spark, stored):
    table, made, chats, counts = stored
    assert sum(r.samples for r in counts.collect()) == made.count()
    assert made.count() == 4 * combine.require_fields(table).count()
    lines = jsonl.read_chat_jsonl(spark, chats)
    assert lines.count() == made.count()
    expected = {(r.question, r.response) for r in made.collect()}
    assert {(r.messages[0].content, r.messages[1].content) for r in lines.collect()} == expected


def test_preparation(spark, stored):
    made = stored[1]
    ready = training.prepare(made)
    n = made.count()
    assert ready.num_samples == n and ready.stats["num_samples"] == n
    held, train = ready.holdout, ready.train
    assert held.count() == max(1, int(n * 0.05)) and train.count() == n - held.count()
    assert train.join(held, "sample_id").count() == 0
    assert "Join" not in plan(train)
    assert training.prepare(made, mode="reference", skip_analysis=True).train.count() == n
    skipped = training.prepare(made, skip_analysis=True, max_seq_length=77)
    assert (skipped.max_seq_length, skipped.stats) == (77, None)
    assert training.prepare(made, skip_analysis=True).max_seq_length == 2048
    with pytest.raises(ValueError):
        training.prepare(made, mode="other", skip_analysis=True)


def test_preparation_from_a_chat_file(spark, stored):
    chats = jsonl.read_chat_jsonl(spark, stored[2])
    twice = training.pairs_from_chats(chats.unionAll(chats))
    n = 2 * stored[1].count()
    assert twice.count() == n == twice.select("sample_id").distinct().count()
    ready = training.prepare(twice)
    assert ready.num_samples == n and ready.holdout.count() == int(n * 0.05)
    assert ready.train.count() == n - int(n * 0.05)


def load_echo():
    return lambda prompts: [p.split("\n")[1].split("<")[0] for p in prompts]


def test_answers_to_reports(spark, stored, tmp_path):
    held = training.prepare(stored[1], skip_analysis=True).holdout
    prompt = render_prompt(F.col("question"))
    answered = training.answer(held, load_echo, prompt, str(tmp_path / "answers"), batch_size=3)
    report, details = training.evaluate_recall(
        answered.withColumn("score", F.lit(0.8)), "run", "now"
    )
    row = report.first()
    assert row.num_samples == held.count() and row.passed.bertscore
    assert sorted(r["index"] for r in details.collect()) == list(range(held.count()))
    items = choice.usable_items(choice.choice_items(standin(spark, SF_DIR, "choice_source")))
    report, details = training.evaluate_choice(items, items, "run", "now")
    assert report.first().performance_drop == 0.0
    assert details.count() == items.count()
    compared = training.compare_reports(
        (training.evaluate_recall(answered.withColumn("score", F.lit(0.8)))[0], report),
        (training.evaluate_recall(answered.withColumn("score", F.lit(0.7)))[0], report),
    ).first()
    assert compared.passed.test1_bertscore is False and compared.passed.test2_accuracy is True


def test_stream_equals_batch(spark, vocab, tmp_path):
    table = combine.drop_duplicates(vocab)
    vocab_csv.write_vocab_csv(table.repartition(3), str(tmp_path / "in"))
    chats = feed.chats_from_stream(feed.vocab_stream(spark, str(tmp_path / "in"), 1))
    for _ in range(2):  # the second run finds nothing new
        feed.write_available(chats, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    batch = pairs.qa_pairs(vocab_csv.read_vocab_csv(spark, str(tmp_path / "in")))
    streamed = spark.read.schema(chats.schema).json(str(tmp_path / "out"))
    assert streamed.count() == batch.count()
    assert streamed.select("sample_id").exceptAll(batch.select("sample_id")).count() == 0


def test_pairs_need_no_shuffle(stored):
    table = stored[0]
    text = plan(pairs.qa_pairs(table))
    assert "Exchange" not in text and "Python" not in text and "Join" not in text
    assert "IsNotNull(Headword)" in text and "IsNotNull(Meaning)" in text


def test_deduplication_is_one_hash_shuffle(stored):
    text = plan(combine.drop_duplicates(stored[0]))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text


def test_counts_read_one_column(stored):
    text = plan(pairs.count_by_type(stored[1]))
    assert "ReadSchema: struct<type:int>" in text


def test_cut_reads_only_the_key(stored):
    cut = sampling.exact_fraction(stored[1], "sample_id").select("sample_id")
    cut.collect()
    schemas = set(re.findall(r"ReadSchema: (\S+)", plan(cut)))
    assert schemas == {"struct<sample_id:string>"}
    assert "Join" not in plan(cut) and "CartesianProduct" not in plan(cut)


def test_stratified_sample_prunes_before_the_shuffle(stored):
    text = plan(sampling.stratified_sample(stored[1], "type", "sample_id", 20))
    limit, exchange = text.rindex("WindowGroupLimit"), text.index("Exchange hashpartitioning")
    assert exchange < limit and "Partial" in text


def test_shuffled_rows_are_read_once(stored):
    text = plan(training.shuffled_chats(stored[1]))
    assert text.count("Exchange") == 1 and "rangepartitioning" not in text
