"""Removal of repeated byte strings by merging Burrows-Wheeler transforms.

Sorting every suffix of the corpus is not needed to find strings of `length` bytes that start twice:

1. Every string of that length has one anchor, the 32-byte gram in it with the smallest hash. Equal
   strings have equal anchors at equal places, so strings whose anchor occurs once are settled.
2. All strings of one anchor lie in its context. Contexts that are equal as a whole are settled, too:
   all their strings repeat. They go on as one copy.
3. What is left are contexts that share an anchor and differ, the ends of repeats. Neighbouring
   strings of a context are a piece; what all strings of a piece have in common is its core. Equal
   strings have equal cores, so pieces are dealt by core and not by anchor, equal pieces as one. The
   pieces of a lot are dealt to shards, each has its suffixes sorted and a transform of its own, and
   the transforms are merged by refining their interleave, one symbol at a time, until it holds for a
   whole string. The places where refinement first tells two neighbours apart give the common
   prefixes, and intervals with a common prefix of a string's length the repeats.

A lot holds whole cores of at most MERGED_BYTES each. A core with more pieces than that is hot; its
strings are grouped by the anchor's place in them and by what they have beside the core, row by row.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.bytesops import mix, powers, text_slices
from termloom.llm.storage import PART, at_place, in_place, placed, stored

LENGTH = 200
GRAM = 32
_BASE = 0xD6E8FEB86659FD93
_U = np.uint64
#: Low bits of a packed minimum hold the place within a slice.
_PLACE = 30


def rolling(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums and inverse powers from which any span's hash follows."""
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * powers(len(data), _BASE)[:-1], out=sums[1:])
    return sums, powers(len(data), pow(_BASE, -1, 1 << 64))


def spans_hash(sums: np.ndarray, inverse: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix(((sums[ends] - sums[starts]) * inverse[starts]) ^ ((ends - starts).astype(_U) * _U(0x9E3779B97F4A7C15)))


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours, by doubling."""
    out, step = values, 1
    while 2 * step <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(row, anchor, first start, last start, anchor hash, context hash) of a slice's strings, as arrays.

    Places count from the row's first byte. Rows shorter than `length` have none.
    """
    none = tuple(np.zeros(0, np.int64) for _ in range(6))
    if len(data) < length:
        return none
    sums, inverse = rolling(data)
    at = np.arange(len(data) - gram + 1)
    grams = spans_hash(sums, inverse, at, at + gram)
    packed = (grams >> _U(_PLACE) << _U(_PLACE)) | at.astype(_U)
    least = (window_minimum(packed, length - gram + 1) & _U((1 << _PLACE) - 1)).astype(np.int64)
    row = np.searchsorted(offsets, np.arange(len(least)), side="right") - 1
    inside = np.arange(len(least)) + length <= offsets[row + 1]
    starts = np.flatnonzero(inside)
    if not len(starts):
        return none
    place, row = least[starts], row[starts]
    head = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (row[1:] != row[:-1])])
    last = np.r_[head[1:], len(starts)] - 1
    first, final, place, row = starts[head], starts[last], place[head], row[head]
    context = spans_hash(sums, inverse, first, final + length) ^ mix((place - first).astype(_U))
    base = offsets[row]
    return row, place - base, first - base, final - base, grams[place], context


def _anchor_rows(length: int, gram: int):
    def run(batches):
        for batch in batches:
            ids = np.array(batch.column(0).to_pylist(), np.int64)
            for first, _, data, offsets in text_slices(batch.column(1)):
                row, place, start, final, name, context = anchors(data, offsets, length, gram)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[first + row], pa.int64()),
                        pa.array(place, pa.int32()),
                        pa.array(start, pa.int32()),
                        pa.array(final, pa.int32()),
                        pa.array(name.view(np.int64)),
                        pa.array(context.view(np.int64)),
                    ],
                    names=["doc_id", "place", "first", "last", "anchor", "context"],
                )

    return run


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The suffix array of symbols whose last one is unique and smallest, by doubling."""
    order, step = np.argsort(text, kind="stable"), 1
    name = np.empty(len(text), np.int64)
    name[order] = np.cumsum(np.r_[False, text[order][1:] != text[order][:-1]])
    while name.max() < len(text) - 1:
        rank = name * (len(text) + 1)
        rank[:-step] += name[step:] + 1
        order = np.argsort(rank, kind="stable")
        name[order] = np.cumsum(np.r_[False, rank[order][1:] != rank[order][:-1]])
        step *= 2
    return order


def merge(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(interleave, common prefix): the source of each suffix in merged order, and what it shares with the one before.

    The interleave starts as the sources one after the other and holds for 0 symbols. One step deals
    the suffixes by the symbol before them, each source in its own order, and makes it hold for one
    symbol more: a source's suffixes keep their order throughout, nothing is sorted anew. Neighbours
    first told apart in step k share k - 1 symbols; those never told apart share `depth`.
    """
    interleave = np.repeat(np.arange(len(transforms), dtype=np.min_scalar_type(len(transforms))), [len(t) for t in transforms])
    every, total = np.concatenate(transforms), len(interleave)
    block, shared = np.zeros(total, np.int32), np.full(total, depth, np.int32)
    symbols = np.empty(total, every.dtype)
    for step in range(1, depth + 1):
        # The symbol before the i-th suffix of the merged order, as far as the interleave holds.
        symbols[np.argsort(interleave, kind="stable")] = every
        turn = np.argsort(symbols, kind="stable")
        interleave, before, block = interleave[turn], symbols[turn], block[turn]
        new = np.r_[True, (before[1:] != before[:-1]) | (block[1:] != block[:-1])]
        shared[new & (shared == depth)] = step - 1
        block = np.cumsum(new, dtype=np.int32)
        if block[-1] == total:
            break
    return interleave, shared


def repeated_starts(shards: list[list[bytes]], length: int) -> list[list[np.ndarray]]:
    """Per shard and text, the places at which a string of `length` bytes starts that starts elsewhere, too.

    UTF-8 has no byte above 0xF4, so that bytes and the two end marks fit into one byte, which sorts faster;
    0xF5 to 0xFD are free for the caller.
    """
    transforms, orders, firsts = [], [], []
    for texts in shards:
        joined = b"".join(texts)
        sizes = np.array([len(t) for t in texts])
        first = np.concatenate([[0], np.cumsum(sizes + 1)])
        symbols = np.ones(int(first[-1]) + 1, np.uint8)  # 1 ends a text, 0 the shard
        symbols[-1] = 0
        where = np.arange(len(joined)) + np.repeat(np.arange(len(texts)), sizes)
        symbols[where] = np.frombuffer(joined, np.uint8) + np.uint8(2)
        order = suffix_order(symbols)
        transforms.append(symbols[order - 1])
        orders.append(order)
        firsts.append(first)
    interleave, shared = merge(transforms, length)
    same = shared >= length
    same[0] = False
    hit = same | np.r_[same[1:], False]
    out = []
    for i, (texts, order, first) in enumerate(zip(shards, orders, firsts, strict=True)):
        places = np.sort(order[hit[interleave == i]])
        text = np.searchsorted(first, places, side="right") - 1
        places = places - first[text]
        fits = places + length <= np.array([len(t) for t in texts])[np.minimum(text, len(texts) - 1)]
        fits &= text < len(texts)
        out.append([places[fits & (text == j)] for j in range(len(texts))])
    return out


#: Bytes of pieces that are merged at once (few enough for the processor's cache), and shards among them.
MERGED_BYTES, SHARDS = 1 << 20, 4
#: Neighbouring strings that form a piece.
CLASS = 24
#: Tables of a few numbers a row are broadcast up to this many rows and joined by shuffle beyond.
BROADCAST_ROWS = 500_000


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _pieces(length: int):
    """(doc_id, start, core, left, right) of each piece of the contested contexts.

    `core` names the anchor, the piece's place to it and the bytes that all its strings share, by 128 bits;
    left and right are the bytes around them.
    """
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part, rows = batch.slice(at, 64), []
                for doc_id, text, spans in zip(part.column(0).to_pylist(), part.column(1), part.column(2).to_pylist(), strict=True):
                    whole = text.as_py().encode()
                    for p in spans:
                        first, lead, raw = p["first"], p["place"] - p["first"], whole[p["first"] : p["end"]]
                        lowest = lead - (len(raw) - length)
                        for c in range(lowest // CLASS, lead // CLASS + 1):
                            low, high = max(lowest, c * CLASS), min(lead, c * CLASS + CLASS - 1)
                            left, right = lead - c * CLASS, lead - (c * CLASS + CLASS - 1) + length
                            core = hashlib.blake2b(struct.pack("<qi", p["anchor"], c) + raw[left:right], digest_size=16).digest()
                            rows.append((doc_id, first + lead - high, core, raw[lead - high : left], raw[right : lead - low + length]))
                columns = zip(*rows, strict=True) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "start", "core", "left", "right"])

    return run


def core_name(number: int) -> bytes:
    """Five bytes; the first is none of UTF-8, so that a name in a string is found at one place only."""
    return bytes([0xF5, *(number >> shift & 0x7F for shift in (21, 14, 7, 0))])


def _merged(length: int):
    """(doc_id, start, end) of the runs of repeated strings in pieces that stand once; a core's pieces follow each other."""

    # Equal strings have one core: its name stands for it, in all strings of a piece whole.
    short = CLASS - 1 + len(core_name(0))

    def work(rows: list[tuple]):
        numbers: dict[bytes, int] = {}
        shards: list[list[tuple]] = [[] for _ in range(min(SHARDS, len(rows)))]
        for i, (doc_id, start, core, left, right, n) in enumerate(rows):
            name = core_name(numbers.setdefault(core, len(numbers)))
            shards[i % len(shards)].append((left + name + right, doc_id, start, n))
        for own, found in zip(shards, repeated_starts([[one[0] for one in s] for s in shards], short), strict=True):
            for (_, doc_id, start, n), at in zip(own, found, strict=True):
                if len(at) and n == 1:
                    cuts = np.flatnonzero(np.diff(at) > 1)
                    lows, highs = at[np.r_[0, cuts + 1]], at[np.r_[cuts, len(at) - 1]]
                    yield from ((doc_id, start + int(lo), start + int(hi) + length) for lo, hi in zip(lows, highs, strict=True))

    def batch_of(rows):
        rows = list(rows)
        columns = zip(*rows, strict=True) if rows else [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["doc_id", "start", "end"])

    def run(batches):
        held, group, size = [], [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # Whole cores are merged together, those of one piece are settled; the next one starts a new lot when this one is full.
                if group and row[2] != group[0][2]:
                    if len(group) > 1:
                        held += group
                        size += sum(len(r[3]) + len(r[4]) + len(core_name(0)) for r in group)
                    group = []
                    if size > MERGED_BYTES:
                        yield batch_of(work(held))
                        held, size = [], 0
                group.append(row)
        held += group if len(group) > 1 else []
        if held:
            yield batch_of(work(held))

    return run


def _by_string(pieces: DataFrame, length: int) -> DataFrame:
    """(doc_id, start, end) of repeated strings in pieces that stand once, for cores with many pieces: strings grouped as rows."""
    # k bytes of a string lie before the core, CLASS - 1 - k behind it; equal strings have equal k.
    size = F.octet_length("left")
    k = F.sequence(F.greatest(F.lit(0), CLASS - 1 - F.octet_length("right")), F.least(F.lit(CLASS - 1), size))
    each = pieces.withColumn("k", F.explode(k)).select(
        "doc_id", "n", "core", "k", (F.col("start") + size - F.col("k")).alias("start"),
        F.substr("left", size - F.col("k") + 1, F.col("k")).alias("l"), F.substr("right", F.lit(1), CLASS - 1 - F.col("k")).alias("r"),
    )
    key = ["core", "k", "l", "r"]
    often = each.groupBy(*key).agg(F.count("*").alias("c")).filter("c > 1").select(*key)
    found = each.filter("n = 1").join(_small(stored(often)), key, "left_semi")
    return found.select("doc_id", F.col("start").cast("int").alias("start"), (F.col("start") + length).cast("int").alias("end"))


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MERGED_BYTES // (2 * CLASS + 3)) -> DataFrame:
    """(doc_id, start, end): runs of bytes of each text whose strings of `length` bytes start elsewhere, too.

    Runs of one document may overlap and touch. Texts shorter than `length`, empty and NULL ones have
    none, and no string crosses two documents. doc_id must not repeat or be NULL (callers pass a row key; with the
    column of `placed`, texts are not moved). Cores of more than
    `most` different pieces do not meet in one task; the result does not depend on it.
    """
    docs = docs.select("doc_id", "text", *(c for c in docs.columns if c == PART))
    every = stored(docs.select("doc_id", "text").mapInArrow(_anchor_rows(length, gram), "doc_id long, place int, first int, last int, anchor long, context long"))
    often = every.groupBy("anchor").agg(F.count("*").alias("c")).filter("c > 1").select("anchor")
    # Stored first, so that Spark can split the join at frequent anchors; they are as many as there is text.
    shared = stored(every.join(stored(often), "anchor"))
    contexts = shared.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "place", "first", "last")).alias("one"))
    contexts = stored(contexts)
    settled = shared.join(contexts.filter("n > 1").select("anchor", "context"), ["anchor", "context"], "left_semi")
    settled = settled.select("doc_id", F.col("first").alias("start"), (F.col("last") + length).alias("end"))

    # Contexts that differ from others of their anchor.
    differ = contexts.groupBy("anchor").agg(F.count("*").alias("c")).filter("c > 1").select("anchor")
    contested = contexts.join(_small(stored(differ)), "anchor").select("one.*", "anchor")
    spans = F.collect_list(F.struct("anchor", "place", "first", (F.col("last") + length).alias("end"))).alias("spans")
    cut = at_place(docs, contested, "doc_id", spans).select("doc_id", "text", "spans")
    with in_place(docs.sparkSession):
        pieces = stored(cut.mapInArrow(_pieces(length), "doc_id long, start int, core binary, left binary, right binary"))

    # Equal pieces repeat as a whole and go on as one.
    kinds = pieces.groupBy("core", "left", "right").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"), F.min("start").alias("start"))
    kinds = stored(kinds)
    equal = pieces.join(kinds.filter("n > 1").select("core", "left", "right"), ["core", "left", "right"], "left_semi")
    end = F.col("start") + F.octet_length("left") + F.octet_length("right") + (length - CLASS + 1)
    equal = equal.select("doc_id", "start", end.alias("end"))
    hot = stored(kinds.groupBy("core").agg(F.count("*").alias("c")).filter((F.col("c") > 1) & (F.col("c") > most)).select("core"))
    few = kinds.join(_small(hot), "core", "left_anti").select("doc_id", "start", "core", "left", "right", "n")
    many = kinds.join(_small(hot), "core", "left_semi")
    count = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = few.repartition(count, "core").sortWithinPartitions("core")
    found = settled.union(equal).union(dealt.mapInArrow(_merged(length), "doc_id long, start int, end int"))
    return found.union(_by_string(many, length))


def _removed(batches):
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    for batch in batches:
        rows = []
        for doc_id, text, runs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            raw = (text.as_py() or "").encode()
            kept, last, removed, n = [], 0, 0, 0
            end = -1
            for r in sorted((r["start"], r["end"]) for r in runs or []):
                if r[0] > end:
                    kept.append(raw[last : r[0]])
                    n, removed, end = n + 1, removed + r[1] - r[0], r[1]
                elif r[1] > end:
                    removed, end = removed + r[1] - end, r[1]
                last = max(last, end)
            kept.append(raw[last:])
            rows.append((doc_id, len(raw), removed, n, hashlib.sha256(b"".join(kept)).hexdigest()))
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document.

    Every byte covered by a string of `length` bytes that starts anywhere else is removed, in all
    places; strings are judged on the input. n_spans counts maximal removed runs. A NULL text is empty;
    an empty table gives no row; other columns are ignored. doc_id may repeat or be NULL.
    """
    docs = placed(docs.select("doc_id", "text"))
    found = repeats(docs.select(F.col("row_").alias("doc_id"), "text", PART), length, gram).withColumnRenamed("doc_id", "row_")
    joined = at_place(docs, found, "row_", F.collect_list(F.struct("start", "end")).alias("runs"), "left")
    out = joined.select("doc_id", "text", "runs").mapInArrow(_removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    with in_place(docs.sparkSession):
        return stored(out)
