"""Best-fit packing planned on the histogram of lengths.

The plan is made for counts: at most `capacity` lengths, whatever the number of documents. Each entry
gives a run of equal pieces their sequences and places; pieces take them by their rank within length.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.storage import stored, worker_state

#: Words, and parts of words, whose ids a worker keeps; beyond it starts anew.
KNOWN_WORDS = 500_000
KNOWN_PARTS = 500_000

# The settings of a tokenizer that lower-cases and cuts words by this pattern, and what the
# pattern means for printable ASCII.
LOWER_CASED = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
PARTS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
SIMPLE_PARTS = "'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ \n\t\r]+"
# Characters for which these steps come to str.lower() and SIMPLE_PARTS: printable ASCII and the letters of Latin-1.
SIMPLE = re.compile("[ -~\n\t\rÀ-ÖØ-öø-ÿ]*")

#: Characters of a text that are cut into parts at a time.
PIECE = 1 << 20


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing on counts: (length, first rank, end rank, first sequence, per sequence, offset).

    Sequences with the same room left are handled together, so the work follows the number of
    different lengths, not of pieces.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    runs, opened = [], 0

    def put(left: int, first: int, count: int) -> None:
        if left and count:
            if left not in room:
                room[left] = []
                rooms.insert(bisect_left(rooms, left), left)
            room[left].append((first, count))

    for length in sorted(histogram, reverse=True):
        rank, todo = 0, histogram[length]
        while todo:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                left = rooms[at]
                first, count = room[left].pop()
                if not room[left]:
                    del room[left], rooms[at]
            else:
                left, first = capacity, opened
                count = -(-todo // (capacity // length))
                opened += count
            each = left // length
            full = min(count, todo // each)
            if full:
                runs.append((length, rank, rank + full * each, first, each, capacity - left))
                put(left - each * length, first, full)
                rank, todo = rank + full * each, todo - full * each
            if full < count and todo:
                runs.append((length, rank, rank + todo, first + full, todo, capacity - left))
                put(left - todo * length, first + full, 1)
                full, todo = full + 1, 0
            put(left, first + full, count - full)
    return runs


class Ids(dict):
    """Token ids of words as bytes (unsigned, little-endian, 32 bits).

    If the tokenizer has the settings above, words are cut into parts (those of simple characters here, others by
    its own steps), and its model is asked once for each part. Words that hold a special token, and all
    words of other tokenizers, go through the whole tokenizer.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.coder = Tokenizer.from_file(file)
        settings = json.loads(self.coder.to_str())
        cut = settings["pre_tokenizer"] or {}
        split = {"type": "Split", "pattern": {"Regex": PARTS}, "behavior": "Removed", "invert": True}
        level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        self.plain = (settings["normalizer"] or {}).get("normalizers") == LOWER_CASED and cut.get("pretokenizers") == [split, level]
        special = [re.escape(t["content"]) for t in settings["added_tokens"]]
        self.special = re.compile("|".join(special) or "(?!)")
        self.cut = re.compile(SIMPLE_PARTS).findall
        self.parts = Parts(self.coder)

    def of(self, text: str) -> bytes:
        """Ids of a whole text; a long one is taken piece by piece, cut at blanks."""
        out, at = [], 0
        while at < len(text):
            end = text.find(" ", at + PIECE) if len(text) - at > PIECE else -1
            piece = text[at:] if end < 0 else text[at:end]
            at += len(piece)
            # Runs of blanks leave empty words, which have no ids.
            words = piece.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            out.append(b"".join(map(self.__getitem__, words)))
        return b"".join(out)

    def __missing__(self, word: str) -> bytes:
        if not self.plain or ("<" in word and self.special.search(word)):
            ids = self.coder.encode(word, add_special_tokens=False).ids
            self[word] = struct.pack(f"<{len(ids)}I", *ids)
        elif SIMPLE.fullmatch(word):
            self[word] = b"".join(map(self.parts.__getitem__, self.cut(word.lower())))
        else:
            cut = self.coder.pre_tokenizer.pre_tokenize_str(self.coder.normalizer.normalize_str(word))
            self[word] = b"".join(self.parts.coded(part) for part, _ in cut)
        return self[word]

    def bound(self) -> None:
        if len(self) > KNOWN_WORDS:
            self.clear()
        if len(self.parts) > KNOWN_PARTS:
            self.parts.clear()


class Parts(dict):
    """Ids of parts of simple characters, in small letters."""

    def __init__(self, coder):
        super().__init__()
        self.cut, self.tokenize = coder.pre_tokenizer.pre_tokenize_str, coder.model.tokenize

    def coded(self, part: str) -> bytes:
        """Ids of a part in the tokenizer's own alphabet of bytes."""
        ids = [t.id for t in self.tokenize(part)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, part: str) -> bytes:
        self[part] = self.coded(part) if part.isascii() else b"".join(self.coded(p) for p, _ in self.cut(part))
        return self[part]


def _pieces(tokenizer: str, capacity: int):
    """Token ids of each text and the end mark 0, cut where longer than a sequence.

    Blanks separate tokens in this tokenizer, so ids are found per word and kept.
    """

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        known = worker_state("packing_ids_" + tokenizer, lambda: Ids(tokenizer))
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                known.bound()
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = known.of(text or "") + bytes(4)
                    for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[start : start + 4 * capacity]
                        out.append((doc_id, piece, start // 4, len(cut) // 4, zlib.crc32(cut)))
            columns = zip(*out, strict=True) if out else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    A NULL or empty text is its end mark alone. Only documents longer than `capacity` are cut. Ties
    and repeated rows take different places; an empty table gives no row; other columns are ignored.
    `tokenizer` is a file whose pre-tokenizer drops white space.
    """
    pieces = docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long")
    # Ranks must not move between passes, so the pieces are stored; `part` splits frequent lengths.
    chunk = F.floor(F.spark_partition_id() * 16 + F.pmod(F.hash("doc_id"), F.lit(16)))
    pieces = stored(pieces.withColumn("chunk", chunk))
    counts = pieces.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("chunk")) - F.col("n")
    offsets = counts.select("length", "chunk", before.alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "chunk").orderBy("doc_id", "piece")) - 1
    ranked = pieces.withColumn("own", own).join(offsets, ["length", "chunk"]).withColumn("rank", F.col("own") + F.col("before"))

    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    runs = docs.sparkSession.createDataFrame(plan(histogram, capacity), "length long, lo long, hi long, first long, each long, at long")
    placed = ranked.join(F.broadcast(runs), (ranked.length == runs.length) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    nth = F.col("rank") - F.col("lo")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        ranked.length,
        "ids_crc32",
        (F.col("first") + F.floor(nth / F.col("each"))).cast("bigint").alias("sequence_id"),
        (F.col("at") + nth % F.col("each") * ranked.length).cast("bigint").alias("offset"),
    )
