"""WARC archives: one gzip member per record, written and read sequentially.

Archives are written by Spark's text writer, which reaches every file system Spark does. A row is one
record's gzip member; the writer ends each row with the line separator, here an empty gzip member, so a file
is a plain sequence of members that any WARC reader takes.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, small_batches

#: Payload bytes that one archive aims at. A larger record makes a larger archive.
ARCHIVE_BYTES = 16_000_000
#: Compressed bytes given to the decompressor at a time.
FEED_BYTES = 65_536
#: Parts into which the rows of one payload are dealt where revisits find their response.
SALTS = 16
#: The capture date stated in every record; the pages table has none.
CAPTURED = "2024-01-01T00:00:00Z"

EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00" + bytes(8)
# Fixed value of the format: the profile of revisits to an equal payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One uncompressed record. A revisit keeps the HTTP header, which states the payload's length."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>"]
    lines.append(f"WARC-Date: {CAPTURED}")
    if url is not None:  # a line break or another control character would end the header line
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += [f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def members(data: bytes | memoryview) -> Iterator[bytes]:
    """The members of an archive in turn, each decompressed piece by piece. Empty ones are passed over."""
    data, at = memoryview(data), 0
    while at < len(data):
        unpacker, out = zlib.decompressobj(31), []
        while not unpacker.eof:
            if at >= len(data):
                raise ValueError("the archive ends inside a member")
            piece = data[at : at + FEED_BYTES]
            out.append(unpacker.decompress(piece))
            at += len(piece) - len(unpacker.unused_data)
        if any(out):
            yield b"".join(out)


def parse(data: bytes) -> dict:
    """Headers, block and payload of one record; raises when its framing or a digest is wrong."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not gap or not version.startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    length = int(fields["content-length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise ValueError("the block does not have its stated length")
    if fields["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError("the block does not have its stated digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(re.search(rb"(?mi)^content-length: *(\d+)", http)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and (len(payload) != stated or base32_sha1(payload) != digest):
        raise ValueError("the payload does not have its stated digest")
    return {"fields": fields, "payload": payload, "payload_bytes": stated, "payload_digest": digest}


def revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id``, ``digest``, ``refers_to`` of pages whose payload another page with a larger id has.

    Payloads are compared by SHA-1 on a narrow table. A payload that many pages share is counted inside each
    task first, and its pages are dealt into ``SALTS`` parts to meet their response. A null id is smallest.
    """
    narrow = pages.select("page_id", F.coalesce("html", F.lit("")).alias("html")).select(
        "page_id", F.octet_length("html").alias("size"), F.sha1("html").alias("digest")
    )
    narrow = narrow.filter(F.col("size") >= min_bytes)
    shared = narrow.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1")
    salted = shared.select("digest", "refers_to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = narrow.select("page_id", "digest", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int").alias("salt"))
    found = dealt.join(salted, ["digest", "salt"]).filter("page_id is null or page_id < refers_to")
    return found.select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """One record per row of ``page_id, url, html``; of equal payloads only the largest id's is a response.

    A null html is an empty payload, a null url gives no target. Payloads cross one shuffle, which deals them
    into archives of about ``ARCHIVE_BYTES``; the small table of revisits is dealt along with them. Repeated
    rows get a record each; rows that share the largest id are responses all.
    """
    total = pages.agg(F.sum(F.octet_length("html")).alias("n")).first().n or 0
    archives = max(1, math.ceil(total / ARCHIVE_BYTES))
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", F.sha1(html).alias("digest"), "url", html.alias("html"), F.lit(None).cast("long").alias("refers_to"))
    marks = revisits(pages, min_bytes).select(
        "page_id", "digest", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "refers_to"
    )
    dealt = small_batches(rows).union(marks).repartition(archives, "page_id", "digest")
    dealt = dealt.sortWithinPartitions("page_id", "digest", F.col("html").isNotNull())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = None
        for batch in chunks(batches):
            out = []
            for page_id, digest, url, text, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if text is None:  # the revisit mark stands before the rows it belongs to
                    mark = page_id, digest, refers_to
                    continue
                refers_to = mark[2] if mark and mark[:2] == (page_id, digest) else None
                out.append(member(record(page_id, url, text.encode(), refers_to)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    (
        dealt.mapInArrow(work, "value binary")
        .select(F.col("value").cast("string").alias("value"))
        .write.option("encoding", "ISO-8859-1")
        .option("lineSep", EMPTY_MEMBER.decode("latin-1"))
        .text(path)
    )


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row per record of all archives below ``path``, with its payload only if asked for.

    An archive is read by one task from front to back. A record whose framing or digest is wrong fails the job.
    """

    def number(urn: str | None) -> int | None:
        text = re.fullmatch(r"<urn:page:(.*)>", urn)[1] if urn else "None"
        return None if text == "None" else int(text)

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())] + [("payload", pa.binary())] * payloads)

    def rows(data) -> Iterator[dict]:
        for raw in members(data):
            found = parse(raw)
            fields = found["fields"]
            row = {
                "page_id": number(fields["warc-record-id"]),
                "url": fields.get("warc-target-uri"),
                "payload_bytes": found["payload_bytes"],
                "payload_digest": found["payload_digest"],
                "record_type": fields["warc-type"],
                "refers_to": number(fields.get("warc-refers-to")),
            }
            yield row | ({"payload": found["payload"]} if payloads else {})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held = []
                for row in rows(content.as_buffer()):
                    held.append(row)
                    if len(held) >= 1000:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
                yield pa.RecordBatch.from_pylist(held, schema)

    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    ddl = ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(work, ddl)
