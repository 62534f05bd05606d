"""Language identification: known words first, then ever shorter character n-grams.

Words and n-grams of the training rows are counted without a bound and stay tables. Words that are
frequent in training are scored where the documents are read; what a document has besides goes, once
a document and word, through a join with the tables, which gives the same numbers.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.storage import stored

LONGEST = 5
#: Scores (words times languages) that are sent to the tasks; words beyond are joined, which gives the same.
SENT = 1_200_000
#: Tables are broadcast in joins up to this many rows and joined by shuffle beyond.
BROADCAST_ROWS = 200_000
#: Different raw words, beside those sent, of which a task keeps the letter words before it starts anew.
KNOWN = 300_000
#: Characters of words whose n-grams are counted at once.
LOT = 300_000
_LETTERS = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def letter_words(raw: str) -> list[str]:
    if raw.isalpha():
        return [raw]
    return [w for w in _LETTERS.findall(raw) if any(c.isalpha() for c in w)]


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of a word, with its ends marked if n allows."""
    word = word if n == 1 else f"^{word}$"
    return [word[i : i + n] for i in range(len(word) - n + 1)]


def _emit(langs, words, n):
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(n, pa.int64())], names=["lang", "word", "n"])


def _count_words(batches):
    counts: dict[str, Counter] = {}

    def flush():
        while counts:
            lang, total = counts.popitem()
            for token in [token for token in total if not token.isalpha()]:
                n = total.pop(token)
                for word in letter_words(token):
                    total[word] += n
            rows = _emit([lang] * len(total), list(total), list(total.values()))
            del total
            yield rows

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            counts.setdefault(lang, Counter()).update(text.as_py().lower().split())
        if sum(map(len, counts.values())) > KNOWN:
            yield from flush()
    yield from flush()


def gram_counts(langs: list[str], words: list[str], times: list[int]):
    """(lang, gram, n) by size: how often the n-grams of `grams_of` occur in words that occur `times` times."""
    names = sorted(set(langs))
    lang = np.searchsorted(names, langs)
    codes = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # characters up to the word's end
    letters, code = np.unique(codes, return_inverse=True)
    times = np.asarray(times, np.int64)
    at, rank = np.arange(len(codes)), lang[word]
    for size in range(1, LONGEST + 1):
        # An n-gram is named by the rank of the one without its last character, and that character.
        stay = left[at] >= size
        at, rank = at[stay], rank[stay] * len(letters) + code[at[stay] + size - 1]
        if not len(at):
            return
        _, first, rank = np.unique(rank, return_index=True, return_inverse=True)
        n = np.bincount(rank, weights=times[word[at]]).astype(np.int64)
        first = at[first]
        if size == 1:  # without the marks
            inner = (codes[first] != ord("^")) & (codes[first] != ord("$"))
            first, n = first[inner], n[inner]
        grams = np.ascontiguousarray(codes[first[:, None] + np.arange(size)]).view(f"<U{size}").ravel()
        yield [names[k] for k in lang[word[first]]], grams.tolist(), n


def _count_grams(batches):
    lot, held = ([], [], []), 0
    for batch in batches:
        for k, column in enumerate(batch.columns):
            lot[k].extend(column.to_pylist())
        held = held + sum(map(len, lot[1][-batch.num_rows :])) if batch.num_rows else held
        if held > LOT:
            for rows in gram_counts(*lot):
                yield _emit(*rows)
            lot, held = ([], [], []), 0
    if held:
        for rows in gram_counts(*lot):
            yield _emit(*rows)


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _scores(counts: DataFrame, langs: list[str]) -> DataFrame:
    """(size, word, total, v): v is the log frequency by language, smoothed by the number of different words of the size."""
    by_lang = F.map_from_entries(F.collect_list(F.struct("lang", "n")))
    each = stored(counts.groupBy("size", "word").agg(by_lang.alias("by"), F.sum("n").alias("total")))
    own = counts.groupBy("size", "lang").agg(F.sum("n").alias("n")).groupBy("size").agg(by_lang.alias("sums"))
    types = each.groupBy("size").agg(F.count("*").alias("types"))
    fixed = F.broadcast(own.join(types, "size"))  # one row a size

    def at(name: str, lang: str) -> Column:
        return F.coalesce(F.try_element_at(F.col(name), F.lit(lang)), F.lit(0))

    v = F.array(*(F.log((at("by", g) + 0.5) / (at("sums", g) + 0.5 * F.col("types"))) for g in langs))
    return each.join(fixed, "size").select("size", "word", "total", v.alias("v"))


def learn(docs: DataFrame) -> tuple[list[str], DataFrame | None, DataFrame | None]:
    """(languages, scores of words, scores of n-grams by size), counted over all given documents.

    Rows without text or language teach nothing; without any row the tables are None.
    """
    rows = docs.select("lang", "text").filter("lang is not null and text is not null")
    words = stored(rows.mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    langs = sorted(r.lang for r in words.select("lang").distinct().collect())
    if not langs:
        return langs, None, None
    grams = stored(words.mapInArrow(_count_grams, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    # An n-gram's length is its size.
    grams = grams.withColumn("size", F.char_length("word"))
    return langs, stored(_scores(words.withColumn("size", F.lit(0)), langs)), stored(_scores(grams, langs))


def most_frequent(words: DataFrame, most: int) -> DataFrame:
    """The words from some power of two of occurrences on, at most `most` of them."""
    power = F.length(F.bin("total")) - 1
    levels = {r.p: r["count"] for r in words.groupBy(power.alias("p")).count().collect()}  # at most 63
    least, held = 64, 0
    for p in sorted(levels, reverse=True):
        held += levels[p]
        if held > most:
            break
        least = p
    return words.filter(power >= least)


def _summed(vectors: Column, langs: list[str]) -> Column:
    """The sum of an array's vectors, in its order."""
    zero = F.array(*(F.lit(0.0) for _ in langs))
    return F.aggregate(vectors, zero, lambda a, v: F.zip_with(a, v, lambda x, y: x + y))


def score_words(wanted: DataFrame, words: DataFrame, grams: DataFrame, langs: list[str]) -> DataFrame:
    """(word, v): scores of a known word, else the mean of its longest known n-grams; words without any are left out."""
    looked = stored(wanted.join(words.select("word", "v"), "word", "left"))
    out, todo = looked.filter("v is not null"), looked.filter("v is null").select("word")
    for size in range(LONGEST, 0, -1):
        if todo.isEmpty():
            break
        marked = F.col("word") if size == 1 else F.concat(F.lit("^"), "word", F.lit("$"))
        long = todo.withColumn("marked", marked).filter(F.char_length("marked") >= size)
        at = F.sequence(F.lit(1), F.char_length("marked") - (size - 1))
        parts = long.select("word", F.posexplode(F.transform(at, lambda i: F.substr(F.col("marked"), i, F.lit(size)))).alias("pos", "gram"))
        known = _small(grams.filter(F.col("size") == size).select(F.col("word").alias("gram"), "v"))
        found = parts.join(known, "gram").groupBy("word").agg(F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("found"))
        total = _summed(F.transform("found", lambda f: f["v"]), langs)
        mean = F.transform(total, lambda x: x / F.size("found"))
        found = stored(found.select("word", mean.alias("v")))
        out = out.union(found)
        todo = stored(todo.join(found.select("word"), "word", "left_anti"))
    return stored(out)


class _Codes(dict):
    """Of each raw word: the place of its only letter word if that is sent, -1 for none, else -2 - k for the letter words others[k]."""

    def __init__(self, place: dict[str, int]):
        super().__init__(place)
        self.place, self.others = place, []

    def __missing__(self, raw: str) -> int:
        words = letter_words(raw)
        if len(words) == 1 and words[0] in self.place:
            code = self.place[words[0]]
        elif words:
            self.others.append(words)
            code = -1 - len(self.others)
        else:
            code = -1
        self[raw] = code
        return code


def _judge_frequent(model):
    """(row_, doc_id, held_out, part, n, rest): the sum over the words sent, the number of words, and the other words."""

    def run(batches):
        place, scores = model.value
        codes = _Codes(place)
        for batch in batches:
            parts, numbers, words, times, ends = [], [], [], [], [0]
            for text in batch.column(3):
                if len(codes) > len(place) + KNOWN:
                    codes = _Codes(place)
                raw = (text.as_py() or "").lower().split()
                code = np.fromiter(map(codes.__getitem__, raw), np.int64, len(raw))
                more: list[int] = []
                rest: dict[str, int] = {}
                for k in code[code < -1].tolist():
                    for word in codes.others[-2 - k]:
                        if word in place:
                            more.append(place[word])
                        else:
                            rest[word] = rest.get(word, 0) + 1
                at, count = np.unique(np.r_[code[code >= 0], np.array(more, np.int64)], return_counts=True)
                parts.append((scores[at] * count[:, None]).sum(axis=0))
                numbers.append(int(count.sum()) + sum(rest.values()))
                words.extend(rest)
                times.extend(rest.values())
                ends.append(len(words))
            flat = np.concatenate(parts) if parts else np.zeros(0)
            rests = pa.StructArray.from_arrays([pa.array(words, pa.string()), pa.array(times, pa.int64())], names=["word", "n"])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.ListArray.from_arrays(pa.array(np.arange(len(parts) + 1) * scores.shape[1], pa.int32()), pa.array(flat)),
                    pa.array(numbers, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rests),
                ],
                names=["row_", "doc_id", "held_out", "part", "n", "rest"],
            )

    return run


def _decide(langs: list[str]):
    def run(batches):
        for batch in batches:
            names, sure = [], []
            for n, part, rest in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
                if not n or not langs:
                    names.append("und")
                    sure.append(0.0)
                    continue
                total = np.array(part) + np.array(rest) if rest else np.array(part)
                best = int(np.argmax(total))
                names.append(langs[best])
                sure.append(float(1 / np.exp(np.clip(total - total[best], -700, 0)).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(sure, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame, train: DataFrame, sent: int = SENT) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document.

    `und` with score 0 for a NULL text or one without letters, or if nothing was learned. Ties take
    the language first in order. Repeated rows are judged alike; other columns are ignored. `sent`
    bounds what is broadcast and changes no result.
    """
    langs, words, grams = learn(train)
    place, scores = {}, np.zeros((0, len(langs)))
    if langs:
        held = most_frequent(words, sent // len(langs)).select("word", "v").toArrow().sort_by("word")  # so that sums go in one order
        place = {w: i for i, w in enumerate(held.column("word").to_pylist())}
        if place:
            scores = held.column("v").combine_chunks().flatten().to_numpy().reshape(-1, len(langs))
    model = docs.sparkSession.sparkContext.broadcast((place, scores))
    rows = docs.select(F.monotonically_increasing_id().alias("row_"), "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text")
    kind = "row_ long, doc_id long, held_out boolean, part array<double>, n long, rest array<struct<word: string, n: long>>"
    judged = stored(rows.mapInArrow(_judge_frequent(model), kind))
    final = judged.withColumn("more", F.lit(None).cast("array<double>"))
    if langs:
        rest = judged.select("row_", F.inline("rest"))
        scored = _small(score_words(rest.select("word").distinct(), words, grams, langs))
        each = rest.join(scored, "word").groupBy("row_").agg(F.array_sort(F.collect_list(F.struct("word", "n", "v"))).alias("found"))
        more = each.select("row_", _summed(F.transform("found", lambda f: F.transform(f["v"], lambda x: x * f["n"])), langs).alias("more"))
        final = judged.join(more, "row_", "left")
    return final.select("doc_id", "held_out", "n", "part", "more").mapInArrow(_decide(langs), "doc_id long, held_out boolean, lang_pred string, score double")
