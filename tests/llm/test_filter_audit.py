"""The filter audit against plain Python."""

from __future__ import annotations

import itertools
import re

import pytest

from termloom.llm import filter_audit

LETTERS = "ABCDE"


def brute(docs, labels):
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, bad in labels if bad == 1 and i is not None}
    failed = []
    for doc_id, text, lang in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": doc_id is not None and any((x or "") == t and i is not None and i < doc_id for i, x, _ in docs),
        }
        failed.append((doc_id, lang or "", {f for f in LETTERS if fails[f]}))
    out = {}
    for part in {p for _, p, _ in failed}:
        own = [(i, f) for i, p, f in failed if p == part]
        shapley = dict.fromkeys(LETTERS, 0)
        for order in itertools.permutations(LETTERS):
            alive = own
            for step, name in enumerate(order, 1):
                here = [(i, f) for i, f in alive if name in f]
                alive = [(i, f) for i, f in alive if name not in f]
                shapley[name] += len(here)
                out[part, "".join(order), step] = [
                    len(alive),
                    len(here),
                    sum(name in f for _, f in own) - len(here),
                    sum(f == {name} for _, f in own),
                    sum(i in good for i, _ in here),
                    sum(i in toxic for i, _ in here),
                ]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return out


def words(n, distinct, extra=""):
    return " ".join(f"w{i % distinct}" for i in range(n)) + extra


DOCS = [
    (1, words(150, 150), "en"),
    (2, words(150, 150), "de"),
    (2, words(150, 150), "de"),
    (3, words(150, 100, " #"), "en"),
    (4, None, None),
    (5, "", None),
    (6, "SHOUTING | short", "en"),
    (7, words(120, 95, " ÄÖ x y"), "en"),
    (8, words(200_000, 170_000, " END"), "fr"),
    (None, words(150, 150), "en"),
    (None, "few", None),
    (9, "a\tb\x0bc\x0cd\re\n" * 30, "en"),
    (10, "few", "en"),
    (11, words(100, 80), "en"),
    (12, words(100, 79), "en"),
    (13, "A" + "b" * 9, "en"),
    (14, "AB" + "b" * 8, "en"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 1, 1), (3, 0, 1), (4, 1, None), (7, None, 1), (None, 1, 1), (99, 1, 1), (10, 1, 0)]


@pytest.mark.parametrize("docs", [DOCS, DOCS[:1], []])
def test_audit_equals_brute_force(spark, docs):
    # Extra columns with the names used inside.
    frame = spark.createDataFrame([(*d, 1, "x", 5) for d in docs], "doc_id long, text string, lang string, row int, filter string, part int")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = filter_audit.audit_documents(frame, labels)
    assert [t for _, t in got.dtypes] == ["string", "string", "int"] + ["bigint"] * 7
    rows = got.collect()
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {(r.part, r.filter_order, r.step): [r[n] for n in names] for r in rows} == brute(docs, LABELS)
    assert len(rows) == 600 * len({lang or "" for _, _, lang in docs})


def test_long_texts_are_split_at_blanks(monkeypatch):
    text = ("word\t" * 50 + "other\x0b" + "x" * 70 + " ") * 5
    whole = filter_audit.word_counts(text.encode())
    monkeypatch.setattr(filter_audit, "PIECE_BYTES", 16)
    assert filter_audit.word_counts(text.encode()) == whole == (len(text.split()), len(set(text.split())))
    assert filter_audit.failed_alone(("é" * 40 + "ABCD").encode()) == 1  # 4 capitals of 44 code points
    assert filter_audit.failed_alone(("é" * 40 + "ABCDE").encode()) == 5


def test_general_filters_of_any_number(spark):
    rows = spark.createDataFrame([(i, i, "p") for i in range(8)], "row long, doc_id long, part string")
    fails = spark.createDataFrame([(i, f) for i in range(8) for b, f in enumerate("xyz") if i >> b & 1], "row long, filter string")
    got = {(r.filter_order, r.step): r for r in filter_audit.audit(rows, fails, {}, "xyz").collect()}
    assert len(got) == 18 and [got["zxy", s].kept for s in (1, 2, 3)] == [4, 2, 1]
    assert got["zxy", 2].redundant == 2 and got["zxy", 2].unique_fails == 1 and got["xyz", 1].shapley == 2 * 4 + 2 * 2 + 2 * 1
