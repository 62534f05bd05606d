"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document. Expectation-maximisation
over the counts of vote patterns (all documents; a few hundred patterns) estimates how each labeller
votes on good and on bad documents and gives every pattern a posterior. These posteriors are the
labels on which a hashed linear scorer is trained; the scorer then judges every document by its words.
"""

from __future__ import annotations

import math
import re
import string
import zlib
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.storage import fresh, sampled, worker_state

#: Documents on which the linear scorer is trained, and labelled ones from which insults are learned.
FIT_ROWS = 8_000
LABELLED_ROWS = 20_000
#: Hashed places of the scorer.
PLACES = 1 << 18
#: Insults kept at most; in how many toxic documents, and how much more often than in others, one must
#: stand; beginnings of words are less telling and must stand there more often still.
INSULTS, INSULT_DOCS, INSULT_RATIO, STEM_RATIO = 500, 8, 30, 150
#: Words of a block over which repetition is judged, at most.
BLOCK = 400
#: Raw words of which a worker keeps what they add; beyond it starts anew.
KNOWN = 600_000

_UPPER = string.ascii_uppercase.encode()
_LOWER = string.ascii_lowercase.encode()
_MARKS = re.compile(r"[^\w\s.,;:'\"()¿¡?!-]")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_STOPS = frozenset(".,;:?!")


def bare(word: str) -> str:
    return word.lower() if word.isalpha() else _EDGE.sub("", word).lower()


def stems(word: str) -> tuple[str, ...]:
    """A word and its beginnings, so that forms of one stem count together."""
    return (word, word[:4] + "*", word[:6] + "*") if word else ()


class Words(dict):
    """Per raw word: its foreign marks, whether it is marks alone, and what `find` tells of the bare word.

    None for most words, which have none of these. At most KNOWN words are kept.
    """

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, raw: str):
        if len(self) > KNOWN:
            self.clear()
        foreign, alone = 0, False
        if raw.isalnum():
            word = raw.lower()
        elif raw[-1] in _STOPS and raw[:-1].isalnum():
            word = raw[:-1].lower()
        else:
            foreign, alone, word = len(_MARKS.findall(raw)), not any(map(str.isalnum, raw)), bare(raw)
        own = self.find(word)
        self[raw] = found = (foreign, alone, own) if foreign or alone or own else None
        return found


def known_words(key: str, basis, find) -> Words:
    """The Words that this worker keeps for `basis`; new ones when the key or the basis differs, and no more than one."""
    held = worker_state("weak_words", dict)
    if held.get("key") != key or not np.array_equal(held["basis"], basis):
        held.update(key=key, basis=basis, words=Words(find))
    return held["words"]


def blocks(words: list[str], most: int = BLOCK) -> list[list[str]]:
    """Consecutive blocks of nearly equal length, at most `most` words each; every word is in one."""
    n, count = len(words), max(1, -(-len(words) // most))
    return [words[i * n // count : (i + 1) * n // count] for i in range(count)] if count > 1 else [words]


def repetition(words: list[str], counts: Counter) -> tuple[float, float, float, float]:
    """Share of different words and of bytes left by compression: means over the blocks, then the worst block of each.

    Blocks make long texts compare with short ones, as both shares fall with length; means are weighted by words.
    """
    distinct = packed = 0.0
    least, densest = 1.0, math.inf
    parts = blocks(words)
    for part in parts:
        own = (len(counts) if len(parts) == 1 else len(set(part))) / len(part)
        raw = " ".join(part).encode()
        left = len(zlib.compress(raw, 1)) / len(raw)
        distinct, packed = distinct + own * len(part), packed + left * len(part)
        least, densest = min(least, own), min(densest, left)
    return distinct / len(words), packed / len(words), least, densest


def traits(text: str, words: list[str], counts: Counter, found: list) -> tuple[float, ...]:
    """Shares of foreign marks and of capitals, marks alone, exclamations, the top word, and `repetition`.

    `counts` are those of the words, `found` what Words says of each word counted.
    """
    raw = text.encode()
    upper = len(raw) - len(raw.translate(None, _UPPER))
    lower = len(raw) - len(raw.translate(None, _LOWER))
    n = len(words)
    foreign = alone = 0
    for c, tells in zip(counts.values(), found, strict=True):
        if tells:
            foreign += c * tells[0]
            alone += c * tells[1]
    return (
        foreign / max(1, n),
        upper / max(1, upper + lower),
        alone / max(1, n),
        text.count("!") / max(1, n),
        max(counts.values()) / n if n >= 20 else 0.0,
        *(repetition(words, counts) if n >= 20 else (1.0, 1.0, 1.0, 1.0)),
    )


def votes(t: tuple[float, ...], insults: int, words: int) -> tuple[int, ...]:
    """1 good, 0 bad, 2 nothing, by labeller."""
    marks, capitals, alone, shouts, top, distinct, packed, least, densest = t
    return (
        0 if marks > 0.3 else 2,
        0 if capitals > 0.5 else 2,
        0 if alone > 0.2 else 2,
        0 if shouts > 0.3 else 2,
        0 if top > 0.25 else 2,
        0 if least < 0.15 else 2,
        0 if densest < 0.2 else 2,
        0 if insults else 2,
        0 if insults > 1 else 2,
        1 if marks < 0.1 and alone < 0.05 and capitals < 0.3 else 2,
        1 if words >= 20 and distinct > 0.3 and packed > 0.3 and least >= 0.15 and densest >= 0.2 else 2,
        0 if not words else 2,
    )


def traits_as_words(t: tuple[float, ...]) -> list[str]:
    """The traits as words of the scorer, one for each step reached."""
    steps = ((0.1, 0.3), (0.3, 0.5), (0.05, 0.2), (0.1, 0.3), (0.15, 0.25))
    out = [f"\x00{i}>{s}" for i, (v, cuts) in enumerate(zip(t[:5], steps, strict=True)) for s in cuts if v > s]
    return out + [f"\x00{i}<{s}" for i, v in enumerate(t[5:], 5) for s in (0.15, 0.2, 0.3) if v < s]


def place_of(word: str) -> int:
    return zlib.crc32(word.encode()) % PLACES


def learn_insults(docs: DataFrame, labels: DataFrame) -> frozenset[str]:
    """Words of toxic labelled documents that hardly stand in others, from at most LABELLED_ROWS labels."""
    marked = labels.select("doc_id", "toxic").filter("doc_id is not null and toxic is not null")
    share = LABELLED_ROWS / max(1, marked.count())
    marked = marked.filter(sampled(share, 6, "doc_id"))
    kinds = {r.toxic: r["count"] for r in marked.groupBy("toxic").count().collect()}
    toxic, other = kinds.get(1, 0), max(1, kinds.get(0, 0))
    words = F.array_distinct(F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+"), lambda w: w != ""))
    starts = (F.transform(words, lambda w: F.concat(F.substring(w, 1, n), F.lit("*"))) for n in (4, 6))
    each = docs.select("doc_id", "text").join(marked, "doc_id")
    each = each.select("toxic", F.explode(F.array_distinct(F.concat(words, *starts))).alias("w"))
    counts = each.groupBy("w").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("o"))
    odds = (F.col("t") / max(1, toxic)) / ((F.col("o") + 1) / other)
    kept = counts.filter(F.col("t") >= max(INSULT_DOCS, toxic // 50)).withColumn("odds", odds).filter(
        F.col("odds") >= F.when(F.col("w").endswith("*"), STEM_RATIO).otherwise(INSULT_RATIO)
    )
    return frozenset(r.w for r in kept.orderBy(F.desc("odds"), "w").limit(INSULTS).collect())


def _votes(shared):
    def run(batches):
        insults, known = shared.value, Words(lambda word: ())
        for batch in batches:
            patterns, places = [], []
            for text in batch.column(0):
                text = text.as_py() or ""
                words = text.split()
                counts = Counter(words)
                t = traits(text, words, counts, list(map(known.__getitem__, counts)))
                distinct = {s for w in counts for s in stems(bare(w))}
                patterns.append("".join(map(str, votes(t, len(insults.intersection(distinct)), len(words)))))
                places.append(sorted({place_of(w) for w in [*distinct, *traits_as_words(t)]}))
            yield pa.RecordBatch.from_arrays([pa.array(patterns, pa.string()), pa.array(places, pa.list_(pa.int32()))], names=["pattern", "places"])

    return run


def _patterns(shared):
    def run(batches):
        insults, patterns = shared.value, Counter()
        known = known_words("insults", sorted(insults), lambda word: [s for s in stems(word) if s in insults])
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py() or ""
                words = text.split()
                counts = Counter(words)
                found = list(map(known.__getitem__, counts))
                hit = {s for tells in found if tells for s in tells[2]}
                patterns["".join(map(str, votes(traits(text, words, counts, found), len(hit), len(words))))] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(patterns), pa.string()), pa.array(list(patterns.values()), pa.int64())], names=["pattern", "n"])

    return run


def expectation_maximisation(patterns: dict[str, int], rounds: int = 100) -> tuple[dict[str, float], np.ndarray]:
    """(posterior of good per pattern, share of each vote given bad and good per labeller)."""
    names = sorted(patterns)
    if not names:
        return {}, np.zeros((0, 2, 3))
    v = np.array([[int(c) for c in p] for p in names])
    n = np.array([patterns[p] for p in names], float)
    onehot = np.stack([v == k for k in range(3)], axis=2).astype(float)
    good = np.where((v == 0).any(axis=1), 0.05, 0.95)
    for _ in range(rounds):
        weight = np.stack([n * (1 - good), n * good])
        rates = (np.einsum("cp,pjk->jck", weight, onehot) + 0.1) / (weight.sum(axis=1)[None, :, None] + 0.3)
        prior = (weight.sum(axis=1) + 1) / (n.sum() + 2)
        logs = np.log(prior)[:, None] + np.einsum("pjk,jck->cp", onehot, np.log(rates))
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))
        moved = np.abs(new - good).max()
        good = new
        if moved < 1e-9:
            break
    return dict(zip(names, good.tolist(), strict=True)), rates


def train_scorer(rows: list[tuple[list[int], float]], epochs: int = 8, seed: int = 6) -> np.ndarray:
    """Logistic regression on presence of hashed words against posterior labels; the last weight is the bias.

    Only words take part whose share of bad documents differs from the overall share by four standard
    errors; others would add up to noise in long texts.
    """
    seen, ill = np.zeros(PLACES), np.zeros(PLACES)
    for places, y in rows:
        seen[places] += 1
        ill[places] += 1 - y
    rate = sum(1 - y for _, y in rows) / max(1, len(rows))
    usual = (seen >= 5) & (np.abs(ill - seen * rate) >= 4 * np.sqrt(np.maximum(seen * rate * (1 - rate), 1e-9)))
    data = [(np.array([p for p in places if usual[p]], int), y) for places, y in rows]
    bad = max(1.0, sum(1 - y for _, y in rows))
    boost = max(1.0, min(20.0, (len(rows) - bad) / bad))
    w, g, rng = np.zeros(PLACES + 1), np.full(PLACES + 1, 1e-2), np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(data)):
            at, y = data[i]
            at = np.append(at, PLACES)
            error = 1 / (1 + np.exp(-np.clip(w[at].sum(), -50, 50))) - y
            error *= boost if y < 0.5 else 1.0
            step = error + 1e-4 * w[at]
            g[at] += step * step
            w[at] -= 0.2 * step / np.sqrt(g[at])
    return w.astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """The scorer's weights. Vote counts cover all documents; FIT_ROWS and LABELLED_ROWS bound the rest."""
    context = docs.sparkSession.sparkContext
    insults = context.broadcast(learn_insults(docs, labels))
    texts = docs.select("text")
    counted = texts.mapInArrow(_patterns(insults), "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    patterns = {r.pattern: r.n for r in counted.collect()}  # at most one per combination of votes
    posterior, _ = expectation_maximisation(patterns)
    share = FIT_ROWS / max(1, sum(patterns.values()))
    some = docs.filter(sampled(share, 7, "doc_id", "text")).select("text")
    rows = some.mapInArrow(_votes(insults), "pattern string, places array<int>").limit(2 * FIT_ROWS).collect()
    return train_scorer([(r.places, posterior.get(r.pattern, 0.5)) for r in rows])


def _score(shared, text_at: int, name: str):
    def run(batches):
        weights = shared.value.tolist()  # plain numbers are read faster one by one
        starts: dict[str, tuple[tuple[int, float], ...]] = {}

        def weighed(s: str) -> tuple[tuple[int, float], ...]:
            p = place_of(s)
            return ((p, weights[p]),) if weights[p] else ()

        def look(word: str) -> tuple[tuple[int, float], ...]:
            if not word:
                return ()
            word, *beginnings = stems(word)
            found = weighed(word)
            if len(starts) > KNOWN:
                starts.clear()
            for s in beginnings:
                if s not in starts:
                    starts[s] = weighed(s)
                found += starts[s]
            return found

        known = known_words("weights", shared.value, look)
        for batch in batches:
            out = []
            for text in batch.column(text_at):
                text = text.as_py() or ""
                words = text.split()
                if not words:
                    out.append(0.0)
                    continue
                counts = Counter(words)
                found = list(map(known.__getitem__, counts))
                total = weights[-1] + math.fsum(dict(chain.from_iterable(tells[2] for tells in found if tells)).values())
                total += sum(weights[place_of(w)] for w in traits_as_words(traits(text, words, counts, found)))
                out.append(1 / (1 + math.exp(-min(50.0, max(-50.0, total)))))
            yield batch.append_column(name, pa.array(out, pa.float64()))

    return run


def with_score(docs: DataFrame, labels: DataFrame, name: str = "quality_score_") -> DataFrame:
    """docs with a score from 0 to 1 (rejected below 0.5) under `name`, every row kept; no column may have that name.

    A NULL text or one without words scores 0. Equal texts score alike; without labels no insult is
    known, and without documents nothing is trained. The corpus must have doc_id and text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(_score(shared, docs.columns.index("text"), name), schema)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, with their own columns."""
    (score,) = fresh(docs.columns, "quality_score_")
    return with_score(docs, labels, score).filter(F.col(score) >= 0.5).drop(score)
