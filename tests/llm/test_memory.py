"""What a Python worker holds between and within tasks."""

import sys
import types

import numpy as np
import pyarrow as pa

from termloom.llm import ngram_jaccard, storage, weak_quality


def test_a_worker_keeps_the_words_of_one_stage_only(monkeypatch):
    made = {}
    monkeypatch.setattr(weak_quality, "worker_state", lambda key, make: made.setdefault(key, make()))
    first = weak_quality.known_words("insults", ["a"], lambda w: ())
    assert weak_quality.known_words("insults", ["a"], lambda w: ()) is first
    second = weak_quality.known_words("weights", np.zeros(3), lambda w: ())
    assert second is not first and len(made) == 1 and next(iter(made.values()))["words"] is second


def test_keys_are_packed_in_small_lots():
    class Common:
        value = (np.zeros(0, np.uint64), np.zeros(0, np.int32))

    rng = np.random.default_rng(1)
    texts = [" ".join(map(str, rng.integers(0, 1 << 60, 3000))) for _ in range(600)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])]
    lots = [sum(len(b) for b in lot.column(2).to_pylist()) // 16 for lot in ngram_jaccard._key_blobs(5, 75, 4, Common)(batches)]
    assert len(lots) > 1 and max(lots) < 300_000


def test_tasks_that_look_for_near_copies_drop_what_a_former_stage_keeps(monkeypatch):
    monkeypatch.setitem(sys.modules, "_worker_state", types.ModuleType("_worker_state"))
    storage.worker_state("weak_words", dict).update(words="many")
    texts = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([7]), pa.array(["a b c d e f"])], names=["row_", "doc_id", "text"])
    assert [b.num_rows for b in ngram_jaccard._describe(5)([texts])] == [1]
    assert storage.worker_state("weak_words", dict) == {}


def test_sets_are_made_for_a_few_texts_at_a_time():
    texts = pa.RecordBatch.from_arrays([pa.array(range(1200)), pa.array(range(1200)), pa.array([f"{i} b c d e f" for i in range(1200)])], names=["row_", "doc_id", "text"])
    assert [b.num_rows for b in ngram_jaccard._describe(5)([texts])] == [500, 500, 200]


def test_a_key_of_two_sets_is_given_as_their_pair():
    # Keys 1 and 2 stand in the same two sets, key 3 in three, key 4 in one.
    entries = np.array([[1, 1, 2, 2, 3, 3, 3, 4], [10, 20, 20, 10, 30, 10, 20, 10]], np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([0], pa.int32()), pa.array([entries.tobytes()])], names=["bucket", "hot", "entries"])
    rows = [tuple(r.values()) for b in ngram_jaccard._repeated([batch]) for r in b.to_pylist()]
    assert rows == [(None, 20, 10), (3, 10, 10), (3, 20, 10), (3, 30, 10)]


def test_long_sketches_tell_large_sets_apart():
    rng = np.random.default_rng(2)
    x, y = (np.unique(rng.integers(0, 1 << 63, 1500).astype(np.uint64)) for _ in range(2))
    wide = pa.array([ngram_jaccard.wide_sketch(s) for s in (x, y)])
    rows = next(ngram_jaccard._long([pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array([1500, 1500]), wide], names=["sig", "n", "wide"])]))
    words = np.array([rows.column(c).to_numpy() for c in ngram_jaccard.LONG])
    assert np.bitwise_count(words[:, 0] ^ words[:, 1]).sum() * 175 > 25 * 3000 >= np.bitwise_count(ngram_jaccard.sketch(x) ^ ngram_jaccard.sketch(y)).sum() * 175


def test_wide_sketches_take_two_places_a_shingle_at_most_and_bound_the_difference():
    rng = np.random.default_rng(4)
    every = rng.integers(0, 1 << 63, 40_000).astype(np.uint64)
    for n in (1, 100, 449, 2048, 2049, 5000, 11_000):
        bits = 8 * len(ngram_jaccard.wide_sketch(every[:n]))
        assert bits & (bits - 1) == 0 and 2048 <= bits <= max(2048, 2 * n)
        for m in (n, n * 4 // 3):
            shared = n * 9 // 10
            other = np.r_[every[:shared], every[20_000 : 20_000 + m - shared]]
            x, y = (np.frombuffer(ngram_jaccard.wide_sketch(s), np.uint64) for s in (every[:n], other))
            assert ngram_jaccard.wide_distance(x, y) <= n - shared + len(other) - shared
            # Sets with nothing in common are told apart at any size.
            apart = np.frombuffer(ngram_jaccard.wide_sketch(every[20_000 : 20_000 + m]), np.uint64)
            assert n < 10 or ngram_jaccard.wide_distance(x, apart) * 175 > 25 * (n + m)
