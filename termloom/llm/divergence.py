"""How far the sources of a language differ in their terms, by a quadtree over the matrix of groups and terms.

Columns are terms, placed by a hash; rows are the groups of a language. The matrix is halved in both directions
again and again (k = 2); a quadrant without a count is not stored. In it a group's share of every term is the one of
a count of 0, so a pair of groups differs there by the same amount for each term, and all such quadrants
together cost one product. What is left is traversed for two blocks of groups at once, down to small dense leaves.
Spark holds the upper levels (a task visits one quadrant of columns for two blocks of rows), a task the lower ones.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.storage import stored

# Fixed values of the shares: documents that a term needs, smoothing, and the whole.
LEAST_DOCS = 30
SMOOTHING = 5
WHOLE = 1_000_000_000
TOP_TERMS = 50

#: Different (group, term) counts that a task holds before it hands them on.
HELD_COUNTS = 1_000_000
#: Bytes of a text that are split into terms at a time.
PIECE_BYTES = 1 << 20
#: Rows of a block, columns of a quadrant (about), rows and columns of a leaf.
BLOCK_ROWS = 32
QUADRANT_TERMS = 256
LEAF_ROWS = 8
LEAF_TERMS = 64

#: Letters of A-Z become small, bytes of other alphabets stay, everything else parts terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def pieces(data: bytes):
    """Terms of a text in lists; a long one is cut where no term goes on."""
    at = 0
    while at < len(data) or not at:
        end = at + PIECE_BYTES
        while end < len(data) and TERM_BYTES[data[end]] != 32:
            end += 1
        yield data[at:end].translate(TERM_BYTES).split()
        at = end


def _count(batches):
    """Occurrences and documents of each term by group; a NULL term says that the group exists."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def counted():
        lang, source, terms, n, docs = [], [], [], [], []
        for (a, b), (words, texts) in groups.items():
            size = len(words) + 1
            lang += [a] * size
            source += [b] * size
            terms += [None, *words]
            n += [0, *words.values()]
            docs += [0, *map(texts.__getitem__, words)]
        arrays = [pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(terms, pa.binary()).view(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, text in zip(langs, sources, batch.column("text").cast(pa.binary()), strict=True):
            words, texts = groups.setdefault((lang, source), (Counter(), Counter()))
            before, own = len(words), set()
            for some in pieces(text.as_py() or b""):
                words.update(some)
                own.update(some)
            texts.update(own)
            held += len(words) - before
            if held > HELD_COUNTS:
                yield counted()
                groups, held = {}, 0
    yield counted()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs), stored; one row with a NULL term for each group."""
    some = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], "text")
    found = some.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return stored(found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(n: str, total: str) -> F.Column:
    """1 + floor(WHOLE * (n + SMOOTHING) / (total + SMOOTHING * terms)), exact for any counts; NULL without terms."""
    smooth = f"cast({n} + {SMOOTHING} as decimal(20,0)) * {WHOLE}"
    whole = f"nullif(cast({total} as decimal(20,0)) + cast({SMOOTHING} * terms as decimal(20,0)), 0)"
    return F.expr(f"1 + ({smooth}) div {whole}")


class Block:
    """Rows [low, high) of the matrix with their cells, ordered by column."""

    def __init__(self, low, high, row, column, p):
        self.low, self.high, self.row, self.column, self.p = low, high, row, column, p

    def part(self, low, high, first, last):
        at, to = np.searchsorted(self.column, (first, last))
        row = self.row[at:to]
        here = (row >= low) & (row < high)
        return Block(low, high, row[here], self.column[at:to][here], self.p[at:to][here])

    def dense(self, zero, first, last):
        out = np.repeat(zero[self.low : self.high, None], last - first, axis=1)
        out[self.row - self.low, self.column - first] = self.p
        return out

    def halves(self):
        if self.high - self.low <= LEAF_ROWS:
            return [(self.low, self.high)]
        middle = (self.low + self.high) // 2
        return [(self.low, middle), (middle, self.high)]


def visit(a: Block, b: Block, first: int, last: int, zero: np.ndarray, value: np.ndarray, visited: np.ndarray) -> None:
    """Add what rows of a and of b differ by in columns [first, last), and the number of columns looked at.

    A pair of quadrants without a cell is left out: its columns stay unvisited.
    """
    if not len(a.p) and not len(b.p):
        return
    rows_a, rows_b = a.halves(), b.halves()
    if last - first <= LEAF_TERMS and len(rows_a) == len(rows_b) == 1:
        x, y = a.dense(zero, first, last), b.dense(zero, first, last)
        for i in range(a.high - a.low):
            value[a.low + i, b.low : b.high] += np.abs(x[i] - y).sum(axis=1)
        visited[a.low : a.high, b.low : b.high] += last - first
        return
    middle = (first + last) // 2
    for lo, hi in [(first, last)] if last - first <= LEAF_TERMS else [(first, middle), (middle, last)]:
        left = [a.part(*rows, lo, hi) for rows in rows_a]
        right = [b.part(*rows, lo, hi) for rows in rows_b]
        for x in left:
            for y in right:
                if x.low <= y.low:  # the same block on both sides: each pair of halves once
                    visit(x, y, lo, hi, zero, value, visited)


def _pairs(frame: pd.DataFrame) -> pd.DataFrame:
    """Partial sums of all pairs of rows of two blocks over one quadrant of columns."""
    lang, one, two = frame["lang"].iat[0], int(frame["one"].iat[0]), int(frame["two"].iat[0])
    marks = frame[frame["term"].isna()].sort_values("row")
    rows, zero = marks["row"].to_numpy(np.int64), marks["p"].to_numpy(np.int64)
    cells = frame[frame["term"].notna()].sort_values(["place", "term"])
    column = (cells["term"] != cells["term"].shift()).cumsum().to_numpy(np.int64) - 1
    row, p = np.searchsorted(rows, cells["row"].to_numpy(np.int64)), cells["p"].to_numpy(np.int64)
    edge = int(np.searchsorted(rows, two * BLOCK_ROWS)) if one < two else len(rows)
    width = int(column[-1]) + 1
    whole = Block(0, len(rows), row, column, p)
    value = np.zeros((len(rows), len(rows)), np.int64)
    visited = np.zeros_like(value)
    a = whole.part(0, edge, 0, width)
    b = whole.part(edge, len(rows), 0, width) if one < two else a
    visit(a, b, 0, width, zero, value, visited)
    x, y = np.nonzero(visited)
    keep = x < y
    x, y = x[keep], y[keep]
    return pd.DataFrame({"lang": lang, "a": rows[x], "b": rows[y], "value": value[x, y], "visited": visited[x, y]})


def pair_sums(cells: DataFrame, groups: DataFrame, levels: int) -> DataFrame:
    """(lang, a, b, value, visited): sums of differences over the stored quadrants, for rows a < b."""
    block = F.expr(f"row div {BLOCK_ROWS}")
    other = F.expr(f"explode(sequence(0, (rows - 1) div {BLOCK_ROWS}))")
    quadrant = F.shiftrightunsigned("place", 64 - levels) if levels else F.lit(0).cast("bigint")
    placed = cells.select("lang", "row", "rows", "term", "p", "place", quadrant.alias("quadrant"))
    paired = placed.withColumn("other", other).select(
        "lang", F.least(block, "other").alias("one"), F.greatest(block, "other").alias("two"), "quadrant", "row", "term", "place", "p"
    )
    key = ["lang", "one", "two", "quadrant"]
    # Rows without a cell in a stored quadrant still count there: each group of both blocks is marked with its zero.
    both = paired.select(key).distinct().withColumn("block", F.explode(F.array_distinct(F.array("one", "two"))))
    marks = both.join(groups.select("lang", block.alias("block"), "row", "zero"), ["lang", "block"])
    marks = marks.select(*key, "row", F.lit(None).cast("string").alias("term"), F.lit(0).cast("bigint").alias("place"), F.col("zero").alias("p"))
    sums = paired.union(marks).groupBy(key).applyInPandas(_pairs, "lang string, a long, b long, value long, visited long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("visited").alias("visited"))


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) of documents (lang, source, text).

    Part `pair`: every other source of the lang, by the sum of differences of the shares of all kept terms. Part
    `term`: terms whose share in the group is above the lang's, the `top` first. NULL lang, source and text are the empty
    string. Groups without terms have pairs; ties go by item; repeated rows count each; an empty table gives no row;
    other columns are ignored. The number of pair rows is that of the sources squared, by definition.
    """
    counts = term_counts(docs)
    kept = counts.filter("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    own = stored(counts.join(kept.filter(F.col("docs") >= least_docs).drop("docs"), ["lang", "term"]).drop("docs"))
    found = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = own.select("lang", "term", "lang_n").distinct().groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    every = counts.filter("term is null").select("lang", "source").join(found, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    by_lang = Window.partitionBy("lang")
    groups = every.withColumns(
        {"row": F.row_number().over(by_lang.orderBy("source")) - 1, "rows": F.count("*").over(by_lang), "zero": F.coalesce(share("0", "total"), F.lit(0))}
    )
    groups = stored(groups)
    cells = own.join(groups, ["lang", "source"]).withColumns({"p": share("n", "total"), "q": share("lang_n", "lang_total"), "place": F.xxhash64("term")})
    cells = stored(cells.select("lang", "source", "term", "row", "rows", "p", "q", "place"))

    most = langs.agg(F.max("terms")).first()[0] or 0
    sums = pair_sums(cells, groups, max(0, -(-int(most) // QUADRANT_TERMS) - 1).bit_length())
    left, right = (groups.select("lang", F.col("row").alias(x), F.col("source").alias(f"source_{x}"), F.col("zero").alias(f"zero_{x}"), "terms") for x in "ab")
    pairs = left.join(right.drop("terms"), "lang").filter("a < b").join(sums, ["lang", "a", "b"], "left").na.fill(0, ["value", "visited"])
    even = (F.col("terms") - F.col("visited")) * F.abs(F.col("zero_a") - F.col("zero_b"))
    pairs = pairs.withColumn("value", F.col("value") + even)
    ways = [F.struct(F.col(f"source_{x}").alias("source"), F.col(f"source_{y}").alias("item")) for x, y in ("ab", "ba")]
    pairs = pairs.select("lang", F.explode(F.array(*ways)).alias("x"), "value")
    pairs = pairs.select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    terms = cells.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).union(terms.withColumn("rank", rank).filter(F.col("rank") <= top))
