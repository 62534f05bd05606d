"""Archives written, damaged and read back."""

from __future__ import annotations

import glob
import gzip
import hashlib
import random
import zlib

import pytest

from termloom.llm import warc

PAGES = "page_id long, url string, html string, kind string, block int, digest int, first string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], PAGES)


BIG = "".join(random.Random(1).choices("abcdefgh é", k=300_000))
ROWS = [
    (7, "http://a.org/1", "p" * 100),
    (3, "http://a.org/2", "p" * 100),
    (9, None, "p" * 100),
    (9, "http://a.org/3 b\r\nX: y", "p" * 100),
    (4, "u", "q" * 99),
    (5, "u", "q" * 99),
    (6, "u", None),
    (8, "u", ""),
    (10, "u", "é" * 50),
    (11, "u", "é" * 50),
    (None, "u", "é" * 50),
    (None, "u", "only here" * 20),
    (12, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\x00\x1f\r\n\r\n" * 9),
    (13, "u", BIG),
    (3, "again", "p" * 100),
]


def brute(rows):
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        same = [i for i, _, h in rows if (h or "").encode() == data and i is not None]
        first = min(same, default=None) if len(data) >= 100 else None
        again = first is not None and page_id != first
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], []])
def test_round_trip(spark, rows):
    got = warc.round_trip(pages(spark, rows))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_archives_are_plain_gzip_and_records_longer_than_a_member_come_back(spark, tmp_path, monkeypatch):
    path = warc.write_archives(pages(spark, ROWS), f"file://{tmp_path}/a").removeprefix("file://")
    whole = b"".join(gzip.decompress(open(f, "rb").read()) for f in glob.glob(path + "/part-*"))
    assert whole.count(b"WARC-Record-ID: ") == len(ROWS) and b"X: y" not in whole.replace(b"%0D%0AX:%20y", b"")
    got = warc.salvage(spark, "file://" + path)
    assert got.filter("kind = 'gap'").count() == 0
    assert {r.record_id: bytes(r.payload).decode() for r in got.collect() if r.payload}["urn:page:13"] == BIG
    content = warc.record("response", "urn:page:1", None, None, BIG.encode(), hashlib.sha256(BIG.encode()).hexdigest())
    parts = warc.members(content, 1000)
    assert [r["payload"].decode() for r in warc.salvaged(parts)] == [BIG]
    assert parts[-1] == 0


def one(i, payload=None, plain=False):
    payload = payload if payload is not None else f"page {i} ".encode() * 40
    made = warc.record("response", f"urn:page:{i}", "u", None, payload, hashlib.sha256(payload).hexdigest())
    return made if plain else warc.members(made)


def ids(found):
    return [int(r["record_id"][9:]) for r in found if r["kind"] == "record"]


def gaps(found):
    return [(r["start"], r["stop"]) for r in found if r["kind"] == "gap"]


def test_whole_archives_of_every_form():
    for parts in ([one(i) for i in range(9)], [one(i, plain=True) for i in range(9)], [one(i, plain=i % 2 == 0) for i in range(9)]):
        assert ids(warc.salvaged(b"".join(parts))) == list(range(9)) and not gaps(warc.salvaged(b"".join(parts)))
    together = warc.members(b"".join(one(i, plain=True) for i in range(9)))
    assert ids(warc.salvaged(together)) == list(range(9))
    assert list(warc.salvaged(b"")) == []


@pytest.mark.parametrize("plain", [False, True])
def test_a_broken_unit_costs_itself_only(plain):
    parts = [one(i, plain=plain) for i in range(6)]
    starts = [sum(map(len, parts[:i])) for i in range(7)]
    whole = b"".join(parts)
    rng = random.Random(5)
    for _ in range(120):
        hit = rng.randrange(6)
        at = rng.randrange(starts[hit], starts[hit + 1])
        bad = bytearray(whole)
        bad[at] ^= 1 << rng.randrange(8)
        found = list(warc.salvaged(bytes(bad)))
        got = {starts.index(r["start"]): r["payload"] for r in found if r["kind"] == "record"}
        # A changed byte of a member's or a plain record's own head may leave its payload as it was.
        assert set(got) >= set(range(6)) - {hit}
        assert all(payload == f"page {i} ".encode() * 40 for i, payload in got.items())
        assert all(starts[hit] <= a and b <= starts[hit + 1] for a, b in gaps(found))
        assert bool(gaps(found)) != (hit in got)


def test_cut_and_foreign_bytes_are_logged():
    parts = [one(i) for i in range(4)]
    a, b = parts[0], b"".join(parts[1:])
    junk = b"\x1f\x8b\x08 not a member, WARC/1.1\r\nWARC-Type: x\r\n\r\n"
    found = list(warc.salvaged(a + junk + b))
    assert ids(found) == [0, 1, 2, 3] and gaps(found) == [(len(a), len(a) + len(junk))]
    found = list(warc.salvaged(b"".join(parts)[:-5]))
    assert ids(found) == [0, 1, 2] and gaps(found) == [(sum(map(len, parts[:3])), sum(map(len, parts)) - 5)]
    found = list(warc.salvaged(a[20:] + b))
    assert ids(found) == [1, 2, 3] and gaps(found) == [(0, len(a) - 20)]
    # The second member of a long record is lost: the record goes, its neighbours stay.
    long = one(9, plain=True)
    halves = [warc.members(long[:200]), warc.members(long[200:])]
    found = list(warc.salvaged(a + halves[0] + b))
    assert ids(found) == [0, 1, 2, 3] and gaps(found) == [(len(a), len(a) + len(halves[0]))]
    assert ids(warc.salvaged(a + b"".join(halves) + b)) == [0, 9, 1, 2, 3]
    inside = warc.members(one(1, plain=True) + b"junk" + one(2, plain=True))
    found = list(warc.salvaged(a + inside + b))
    assert ids(found) == [0, 1, 2, 1, 2, 3] and gaps(found) == [(len(a), len(a) + len(inside))]


def test_digests_of_both_spellings():
    made = one(1, b"x" * 200, plain=True)
    sha1 = hashlib.sha1(b"x" * 200)
    import base64

    for value in (sha1.hexdigest(), base64.b32encode(sha1.digest()).decode()):
        assert warc.digest_is("sha1:" + value, b"x" * 200) and not warc.digest_is("sha1:" + value, b"y")
    wrong = made.replace(b"x" * 200, b"x" * 199 + b"y")
    assert ids(warc.salvaged(wrong)) == []
    assert zlib.crc32(made) != zlib.crc32(wrong)


def test_damaged_folder_on_spark(spark, tmp_path):
    path = warc.write_archives(pages(spark, ROWS).repartition(3), f"file://{tmp_path}/b").removeprefix("file://")
    files = sorted(glob.glob(path + "/part-*"))
    data = bytearray(open(files[0], "rb").read())
    data[:4] = b"\0\0\0\0"
    open(files[0], "wb").write(bytes(data))
    for crc in glob.glob(path + "/.part-*.crc"):
        open(crc, "wb").close()
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
    found = warc.salvage(spark, "file://" + path).select("kind", "record_id", "start", "stop").collect()
    assert len([r for r in found if r.kind == "record"]) >= len(ROWS) - 1 and [r.start for r in found if r.kind == "gap"] == [0]
