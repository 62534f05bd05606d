"""Registered queries that SQL cannot express, over whole tables, against plain Python; and the pipeline stage by stage."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from test_llm import brute_components, brute_hits, brute_repeats

from __spark_entry__ import queries
from termloom.llm import surrogates
from termloom.llm.queries import vocabulary

SF_DIR = "/root/testdata/sf0.001"
BASE = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
}


def rows_of(name):
    return pq.read_table(f"{SF_DIR}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def documents():
    return {r["doc_id"]: r["text"] for r in rows_of("documents")}


def run(spark, name):
    return [r.asDict() for r in queries()[name](spark, SF_DIR).collect()]


def test_op4_secrets(spark, documents):
    for r in run(spark, "op4_secrets"):
        text, found = documents[r["doc_id"]] or "", []
        for order, (kind, (pattern, good)) in enumerate(BASE.items()):
            own = [m for m in re.finditer(pattern, text) if good(m)]
            assert r[f"n_{kind}"] == len(own)
            found += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in own]
        spans = [s for _, _, s in sorted(found)]
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [s for s in r["spans"].split(",") if s.split(":")[0] in BASE] == spans


def test_op5_embedding_forest(spark):
    vectors = rows_of("embeddings")
    unit, root, links = {}, {}, Counter()
    for v in vectors:
        x = None if v["embedding"] is None or None in v["embedding"] else np.array(v["embedding"], np.float64)
        ok = x is not None and len(x) and np.isfinite(x).all() and np.linalg.norm(x) > 0 and v["label"] is not None
        unit[v["vec_id"]], root[v["vec_id"]] = (x / np.linalg.norm(x) if ok else None), v["vec_id"]
    labels = defaultdict(list)
    for v in vectors:
        if unit[v["vec_id"]] is not None:
            labels[v["label"]].append(v["vec_id"])

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for ids in labels.values():
        for k, i in enumerate(sorted(ids)):
            for j in sorted(ids)[k + 1 :]:
                if len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93:
                    links[i] += 1
                    links[j] += 1
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in run(spark, "op5_embedding_forest")}
    assert got == {i: (links[i], find(i), find(i) == i) for i in unit}


def packed_right(rows, documents):
    """Ids, cuts and places; no sequence overlaps, has a gap, or is longer than it may be."""
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(vocabulary())
    pieces, places = defaultdict(dict), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]][r["piece"]] = r
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(documents)
    for i, text in documents.items():
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(-(-len(ids) // 2048)):
            part, r = ids[2048 * k : 2048 * k + 2048], pieces[i].pop(k)
            assert (r["start"], r["length"], r["ids_crc32"]) == (2048 * k, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)))
        assert not pieces[i]
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(length for own in places.values() for _, length in own) // 2048)
    assert len(places) <= 1.02 * least + 1


def test_op7_packing(spark, documents):
    packed_right(run(spark, "op7_packing"), documents)


def test_op8_language(spark, documents):
    langs = {r["doc_id"]: r["lang"] for r in rows_of("documents")}
    rows = run(spark, "op8_language")
    assert {r["doc_id"] for r in rows} == set(documents)
    judged = [r for r in rows if r["held_out"] and langs[r["doc_id"]]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in judged) >= 0.9 * len(judged) > 0


def test_op9_suffix_merge(spark, documents):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in run(spark, "op9_suffix_merge")}
    assert got == brute_repeats(documents)


def test_op10_ngram_jaccard(spark, documents):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in run(spark, "op10_ngram_jaccard")}
    assert got == brute_components(documents)


def personal(text):
    return re.findall(surrogates.FORMS["email"].replace("++", "+").replace(r"\p{L}\p{N}", r"\w"), text or "")


def test_op1_surrogates(spark, documents):
    rows = run(spark, "op1_surrogates")
    assert {r["doc_id"] for r in rows} == set(documents)
    mails = {m.lower() for t in documents.values() for m in personal(t)}
    found, given = 0, {}
    for r in rows:
        old, new = documents[r["doc_id"]], r["text"]
        if not r["n_entities"]:
            assert new == old
            continue
        found += 1
        assert new != old and not {m.lower() for m in personal(new)} & mails
        for a, b in zip(personal(old), personal(new), strict=True):
            assert given.setdefault(a.lower(), b.lower()) == b.lower()
    assert found and len(set(given.values())) == len(given)


def test_op6_weak_quality(spark):
    """On a table with enough labels: clean documents stay, junk goes, and most toxic prose."""
    folder = SF_DIR.replace("sf0.001", "sf0.01")
    rows = {r.doc_id: r for r in queries()["op6_weak_quality"](spark, folder).collect()}
    assert len(rows) == pq.read_metadata(f"{folder}/documents.parquet").num_rows
    assert all(0 <= r.score <= 1 and r.keep == (r.score >= 0.5) for r in rows.values())
    kept = defaultdict(list)
    for r in pq.read_table(f"{folder}/labels.parquet").to_pylist():
        kept[r["quality"], r["toxic"]].append(rows[r["doc_id"]].keep)
    assert np.mean(kept[1, 0]) >= 0.97 and np.mean(kept[0, 0]) <= 0.03 and np.mean(kept[1, 1]) <= 0.4


def test_pipeline_stage_by_stage(spark, documents):
    import corpus_pipeline

    docs, kept, last = spark.read.parquet(f"{SF_DIR}/documents.parquet"), documents, None
    columns = docs.columns
    items = [(r["item_id"], r["text"]) for r in rows_of("benchmark")]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        if name == "pack":
            packed_right([r.asDict() for r in out.collect()], kept)
            last = {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out.collect()}
            break
        docs = corpus_pipeline.stored(out)
        assert docs.columns == columns
        now = {r.doc_id: r.text for r in docs.collect()}
        if name == "quality":
            judged = {r["doc_id"] for r in run(spark, "op6_weak_quality") if r["keep"]}
            assert set(now) == judged
        elif name == "near_copies":
            assert set(now) == {i for i, (_, c) in brute_components(kept).items() if c == i}
        elif name == "decontamination":
            assert set(now) == {i for i, t in kept.items() if not brute_hits(t, items)[1]}
        elif name == "personal_data":
            assert set(now) == set(kept) and not any(set(personal(t)) & set(personal(kept[i])) for i, t in now.items())
            documents_changed = [i for i, t in now.items() if t != kept[i]]
            assert all(t == kept[i] for i, t in now.items() if i not in documents_changed)
            kept = now
            continue
        assert set(now) <= set(kept) and all(now[i] == kept[i] for i in now)
        kept = now
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in run(spark, "pipeline")} == last
