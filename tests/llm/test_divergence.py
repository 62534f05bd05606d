"""The divergence of sources against plain Python."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from termloom.llm import divergence


def brute(docs, least, top):
    counts, texts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups.add((lang, source))
        counts[lang, source].update(words)
        texts[lang].update(set(words))
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for t, n in texts[lang].items() if n >= least]
        own = sorted(s for g, s in groups if g == lang)

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q = shares(sum((counts[lang, s] for s in own), Counter()))
        p = {s: shares(counts[lang, s]) for s in own}
        for s in own:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in own if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, rows, most in (("pair", pairs, None), ("term", terms, top)):
                rows.sort(key=lambda r: (-r[1], r[0].encode()))
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(rows[:most], 1)]
    return sorted(out)


def corpus(seed, docs, sources, vocabulary):
    rng = np.random.default_rng(seed)
    words = [f"{'aeiou'[i % 5]}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{'éßД'[i % 3]}" for i in range(vocabulary)]
    out = []
    for i in range(docs):
        source = f"s{int(rng.integers(sources)) if i % 3 else 0}"
        own = rng.zipf(1.3, 40) % vocabulary
        out.append((("en", "de")[i % 5 == 0], source, ", ".join(words[j].upper() if j % 7 == 0 else words[j] for j in own)))
    return out


ODD = [(None, None, None), (None, None, "A b_c"), ("", "x", ""), ("fr", "one", "1 2 3"), ("fr", None, "été"), ("xx", "alone", "z " * 400_000)]


@pytest.mark.parametrize(
    ("docs", "least"),
    [(corpus(1, 400, 6, 300) + ODD, 3), (corpus(2, 900, 90, 900) + ODD, 2), (corpus(3, 60, 3, 40) * 2, 1), (ODD, 30), ([], 30)],
)
def test_divergence_equals_brute_force(spark, monkeypatch, docs, least):
    # Extra columns with names used inside.
    frame = spark.createDataFrame([(*d, 1, "t", 2, 3, 0) for d in docs], "lang string, source string, text string, n int, term string, docs int, row int, p int")
    monkeypatch.setattr(divergence, "QUADRANT_TERMS", 64)
    got = divergence.divergence(frame, least, 7)
    assert [t for _, t in got.dtypes] == ["string", "string", "string", "string", "bigint", "int"]
    assert sorted(map(tuple, got.collect())) == brute(docs, least, 7)


def test_shares_are_exact_for_very_large_counts(spark):
    n, total, terms = 9 * 10**17, 5 * 10**18, 123_456_789
    frame = spark.createDataFrame([(n, total, terms)], "n long, total long, terms long")
    assert frame.select(divergence.share("n", "total")).first()[0] == 1 + 10**9 * (n + 5) // (total + 5 * terms)


def test_long_texts_are_cut_between_terms(monkeypatch):
    data = ("Ab cd-éf. " * 40).encode()
    whole = [t for some in divergence.pieces(data) for t in some]
    monkeypatch.setattr(divergence, "PIECE_BYTES", 7)
    assert [t for some in divergence.pieces(data) for t in some] == whole
    assert list(divergence.pieces(b"")) == [[]]


def test_quadrants_without_cells_are_not_visited():
    rows, columns = 64, 512
    rng = np.random.default_rng(4)
    zero = rng.integers(1, 50, rows)
    at = np.sort(rng.choice(np.arange(384, columns), 60, replace=False))
    row = rng.integers(0, 9, 60)
    whole = divergence.Block(0, rows, row, at, rng.integers(1, 900, 60))
    value, visited = np.zeros((rows, rows), np.int64), np.zeros((rows, rows), np.int64)
    divergence.visit(whole, whole, 0, columns, zero, value, visited)
    assert visited[40, 63] == 0 and 0 < visited[0, 1] <= 128
    dense = whole.dense(zero, 0, columns)
    exact = np.abs(dense[:, None, :] - dense[None, :, :]).sum(axis=2)
    rest = (columns - visited) * np.abs(zero[:, None] - zero[None, :])
    upper = np.triu_indices(rows, 1)
    assert (exact == value + rest)[upper].all()
