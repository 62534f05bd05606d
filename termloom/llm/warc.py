"""WARC archives: a writer of one gzip member per record, and a reader that salvages damaged ones.

Writer: each record is deflated on its own, as a member of at most MEMBER_BYTES of content (a longer record takes
several). The highest byte of such a member's size field, its last byte, is 0; Spark's text writer supplies
it as the line separator, so archives are exact bytes, written and committed by Spark wherever it can write.

Reader: a unit (members of a record, or a plain record) counts only if all checks hold: the member's checksum and size,
version line, header lines, length, closing mark, digests. Otherwise the reader looks for the next member or version line
that passes them, and logs the bytes in between as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.storage import shared_dir, stored

MEMBER_BYTES = 1 << 23
#: Members are handed to the writer in blocks of about this many bytes; an archive holds so many blocks.
BLOCK_BYTES = 1 << 20
ARCHIVE_BLOCKS = 64
#: Payloads below this many bytes are never replaced by a revisit.
LEAST_REVISIT = 100
HEADER_BYTES = 1 << 20
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = re.compile(rb"WARC/\d\.\d\r\n")
START = re.compile(rb"\x1f\x8b\x08|WARC/\d\.\d\r\n")

FOUND = (
    "kind string, archive string, start long, stop long, reason string, record_type string, record_id string,"
    " target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"
)


# Writing


def record(kind: str, record_id: str, uri: str | None, refers_to: str | None, payload: bytes, digest: str) -> bytes:
    """One record; a revisit keeps the header of the answer only."""
    block = HTTP if kind == "revisit" else HTTP + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}"]
    if uri:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri))
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    lines += [
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def members(content: bytes, size: int = MEMBER_BYTES) -> bytes:
    out = []
    for at in range(0, len(content), size):
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        out += [packer.compress(content[at : at + size]), packer.flush()]
    return b"".join(out)


def _blocks(batches):
    """Runs of whole members, each without its last byte, which is 0."""
    held, size = [], 0

    def block():
        return pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], names=["block"])

    for batch in batches:
        for i in range(batch.num_rows):
            kind, record_id, uri, refers_to, payload, digest = (batch.column(c)[i].as_py() for c in range(6))
            held.append(members(record(kind, record_id, uri, refers_to, payload or b"", digest)))
            size += len(held[-1])
            if size >= BLOCK_BYTES:
                yield block()
                held, size = [], 0
    if held:
        yield block()


def write_archives(pages: DataFrame, path: str, least_revisit: int = LEAST_REVISIT) -> str:
    """Archives of pages (page_id, url, html) in the folder `path`, one record a row; gives `path`.

    Of rows with equal html of at least `least_revisit` bytes, those with the smallest page_id are responses (repeated
    rows: each), the others revisit it. NULL html is empty; a NULL page_id is never the smallest, and a response if no
    row with its html has one. An empty table gives a folder without records. Other columns are ignored.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha2(html, 256).alias("digest"))
    same = rows.filter(F.octet_length("html") >= least_revisit).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    # Stored, so that its true size decides between a broadcast and a join by digest that splits hot digests.
    same = stored(same.filter("n > 1 and first is not null").select("digest", "first"))
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))

    def name(page_id):
        return F.concat(F.lit("urn:page:"), F.coalesce(F.col(page_id).cast("string"), F.lit("")))

    written = rows.join(same, "digest", "left").select(
        F.when(again, "revisit").otherwise("response").alias("kind"),
        name("page_id").alias("record_id"),
        "url",
        F.when(again, name("first")).alias("refers_to"),
        F.when(~again, F.col("html").cast("binary")).alias("payload"),
        "digest",
    )
    blocks = written.mapInArrow(_blocks, "block binary").select(F.col("block").cast("string").alias("block"))
    blocks.write.option("lineSep", "\0").option("maxRecordsPerFile", ARCHIVE_BLOCKS).text(path)
    return path


# Reading


class Bad(ValueError):
    """A unit fails its checks."""


class Short(Bad):
    """A record goes on behind the bytes at hand."""


def digest_is(declared: str, data: bytes) -> bool:
    """Whether data has the digest `name:value`, in hex or base 32; digests of unknown kinds are not judged."""
    kind, _, value = declared.strip().partition(":")
    kind = kind.lower().replace("-", "")
    if kind not in ("md5", "sha1", "sha256", "sha512"):
        return True
    own = hashlib.new(kind, data)
    return value.lower() == own.hexdigest() or value.upper().rstrip("=") == base64.b32encode(own.digest()).decode().rstrip("=")


def parse(data: bytes, at: int) -> tuple[dict, int]:
    """The record that starts at `at`, and its end."""
    first = VERSION.match(data, at)
    if not first:
        if len(data) - at < 10 and b"WARC/".startswith(data[at : at + 5]):
            raise Short("version line ends early")
        raise Bad("no version line")
    close = data.find(b"\r\n\r\n", first.end() - 2, at + HEADER_BYTES)
    if close < 0:
        raise (Short if len(data) < at + HEADER_BYTES else Bad)("header does not end")
    head: dict[str, str] = {}
    last = None
    for line in bytes(data[first.end() : close]).decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and last:
            head[last] += " " + line.strip()
            continue
        last, colon, value = line.partition(":")
        last = last.strip().lower()
        if not colon or not last:
            raise Bad("header line without a name")
        head[last] = value.strip()
    if "warc-type" not in head or not re.fullmatch(r"\d{1,18}", head.get("content-length", "")):
        raise Bad("no type or length")
    stop = close + 4 + int(head["content-length"])
    if len(data) < stop + 4:
        raise Short("record ends early")
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise Bad("record does not end at its length")
    block = bytes(data[close + 4 : stop])
    if not digest_is(head.get("warc-block-digest", ""), block):
        raise Bad("block digest differs")
    return unpacked(head, block), stop + 4


def unpacked(head: dict, block: bytes) -> dict:
    kind, payload = head["warc-type"].lower(), block
    if head.get("content-type", "").lower().startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    declared = head.get("warc-payload-digest", "")
    found = {"record_type": kind, "record_id": head.get("warc-record-id", "").strip("<>"), "target_uri": head.get("warc-target-uri")}
    if kind == "revisit":
        return found | {"refers_to": head.get("warc-refers-to", "").strip("<>"), "payload_digest": declared.partition(":")[2]}
    if not digest_is(declared, payload):
        raise Bad("payload digest differs")
    return found | {"payload_digest": hashlib.sha256(payload).hexdigest(), "payload_bytes": len(payload), "payload": payload}


def inflate(data: bytes, at: int) -> tuple[bytes, int]:
    """Content and end of the gzip member at `at`; its checksum and size hold."""
    engine, out, view = zlib.decompressobj(31), [], memoryview(data)
    while not engine.eof:
        if at >= len(data):
            raise Bad("member ends early")
        some = view[at : at + 65536]
        try:
            out.append(engine.decompress(some))
        except zlib.error as e:
            raise Bad(f"member: {str(e).rpartition(': ')[2]}") from e
        at += len(some)
    return b"".join(out), at - len(engine.unused_data)


def unit(data: bytes, at: int) -> tuple[list[dict], list[str], int]:
    """Records that start at `at`, what is wrong inside a member that holds several, and the end of the unit."""
    if not data.startswith(MAGIC, at):
        found, stop = parse(data, at)
        return [found], [], stop
    content, stop = inflate(data, at)
    content, here, records, wrong = bytearray(content), 0, [], []
    while here < len(content) or not records and not wrong:
        try:
            found, here = parse(content, here)
            records.append(found)
        except Short as e:
            try:
                if not data.startswith(MAGIC, stop):
                    raise e
                more, after = inflate(data, stop)
                if VERSION.match(more):
                    raise e
            except Bad:
                if not records:
                    raise e from None
                wrong.append(f"{e}, inside a member from byte {here}")
                break
            content += more
            stop = after
        except Bad as e:
            following = VERSION.search(content, here + 1)
            if not following and not records:
                raise
            wrong.append(f"{e}, inside a member from byte {here}")
            if not following:
                break
            here = following.start()
    if not records:
        raise Bad(wrong[0])
    return records, wrong, stop


def salvaged(data: bytes):
    """Records and gaps of one archive, in order; every byte is in a record's unit or in a gap."""
    at, lost, why = 0, None, ""
    while at < len(data):
        try:
            records, wrong, stop = unit(data, at)
        except Bad as e:
            if lost is None:
                lost, why = at, str(e)
            following = START.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if lost is not None:
            yield {"kind": "gap", "start": lost, "stop": at, "reason": why}
            lost = None
        for found in records:
            yield {"kind": "record", "start": at, "stop": stop, **found}
        for reason in wrong:
            yield {"kind": "gap", "start": at, "stop": stop, "reason": reason}
        at = stop
    if lost is not None:
        yield {"kind": "gap", "start": lost, "stop": len(data), "reason": why}


def _salvage(payload: bool):
    names = [c.split()[0] for c in FOUND.split(",")]
    kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in FOUND.split(",")]

    def run(batches):
        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                held, size = [], 0
                for found in salvaged(batch.column(1)[i].as_py()):
                    found["archive"] = batch.column(0)[i].as_py()
                    if not payload:
                        found.pop("payload", None)
                    held.append(found)
                    size += 500 + len(found.get("payload") or b"")
                    if size >= BLOCK_BYTES:
                        yield batch_of(held)
                        held, size = [], 0
                if held:
                    yield batch_of(held)

    return run


def salvage(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Rows FOUND of all archives below `path`: records, and gaps with their bytes and reason (the quarantine log).

    Compressed and plain archives may be mixed. An archive is read whole by one task (write_archives bounds its
    own to 64 blocks), an empty one gives no row. A broken record whose payload holds a whole
    valid record gives that one, as the bytes do not tell them apart. `payload=False` leaves payloads out.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_salvage(payload), FOUND)


def resolved(found: DataFrame) -> DataFrame:
    """Records of salvage(), stored; a revisit gets the payload size of the response that it names.

    `found` is read once. A revisit whose response was lost, or has another payload, keeps a NULL size.
    """
    records = stored(found.filter("kind = 'record'").drop("payload"))
    answers = records.filter("record_type <> 'revisit'")
    answers = stored(answers.groupBy(F.col("record_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("size")))
    sized = records.filter("record_type = 'revisit'").join(answers, ["refers_to", "payload_digest"], "left").withColumn("payload_bytes", F.col("size"))
    return records.filter("record_type <> 'revisit'").unionByName(sized.drop("size"))


def round_trip(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of pages, written and read back."""
    spark = pages.sparkSession
    path = write_archives(pages, f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}")

    def page(column):
        return F.expr(f"try_cast(substring({column}, 10) as bigint)")

    return resolved(salvage(spark, path, payload=False)).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to")
    )
