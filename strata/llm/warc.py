"""WARC archives compressed record by record with a shared Zstandard dictionary.

A file begins with a skippable frame that holds the dictionary; each record is a frame of its
own. Spark's text writer writes the frames in rows of about a megabyte; between rows it puts an
empty skippable frame, which readers pass over, so the files are plain .warc.zst content."""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import discard, in_batches, shuffles_removed, stage

DICTIONARY_FRAME = 0x184D2A5D
EMPTY_FRAME = "P*M\x18\0\0\0\0"  # magic 0x184D2A50 and a length of 0
SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 16_384, 110_000
ROW_BYTES, LEVEL = 1 << 20, 6
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
COLUMNS = ("page_id long, url string, record_type string, payload_bytes long, "
           "payload_digest string, refers_to long, payload binary")


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _name(page_id: int | None, tag: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{tag}')}>"


def record(page_id, tag, url, payload: bytes, sha1: str, refers_to, refers_tag,
           date: str = DATE) -> bytes:
    """One WARC record; a revisit (refers_tag given) has the HTTP head but no payload."""
    revisit = refers_tag is not None
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page_id, tag)}", f"WARC-Date: {date}",
        url is not None and f"WARC-Target-URI: {quote(url, safe=URL_CHARACTERS)}",
        page_id is not None and f"WARC-Page-ID: {page_id}",
        revisit and f"WARC-Profile: {PROFILE}",
        revisit and f"WARC-Refers-To: {_name(refers_to, refers_tag)}",
        revisit and refers_to is not None and f"WARC-Refers-To-Page-ID: {refers_to}",
        f"WARC-Payload-Digest: sha1:{base32(bytes.fromhex(sha1))}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(x for x in head if x).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


URL_CHARACTERS = "".join(chr(c) for c in range(0x21, 0x7F))


def train(records: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from sample records; empty if they are too few to train one."""
    try:
        return zstandard.train_dictionary(size, records, threads=0).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=True)


def _frames(batches: Iterator[pa.RecordBatch], dictionary: bytes) -> Iterator[pa.RecordBatch]:
    squeeze = _compressor(dictionary)
    lead = struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary if dictionary else b""
    held, size, started = [lead], len(lead), False
    for batch in batches:
        for at in range(batch.num_rows):
            started = True
            page_id, tag, url, html, sha1, refers_to, refers_tag = (
                c[at].as_py() for c in batch.columns)
            frame = squeeze.compress(record(page_id, tag, url, (html or "").encode(), sha1,
                                            refers_to, refers_tag))
            held.append(frame)
            size += len(frame)
            if size >= ROW_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)])], ["value"])
                held, size = [], 0
    if started and held:
        yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)])], ["value"])


def write_warc(pages: DataFrame, path: str, id: str = "page_id", url: str = "url",
               html: str = "html", least_bytes: int = 0) -> None:
    """Write one record per row of pages below `path`.

    Of equal payloads of at least `least_bytes` the row with the least id (null ids last) is a
    response and the others are revisits of it; smaller ones are all responses. Null html is
    an empty payload; a null url or id has no field; of rows that repeat the least id one is
    the response. Other columns are not looked at; an empty table gives no file.

    The dictionary is trained on at most 1000 records, the first by digest, of 16 KB each at
    most; both bounds are parameters of this module. Payloads are shuffled once, by digest, for
    the join with the groups, and each of Spark's partitions (a hot digest makes several) is
    written as a file. Equal payloads are counted on the map side."""
    spark = in_batches(pages).sparkSession
    whole = F.coalesce(F.col("html"), F.lit(""))
    stored = stage(pages.select(
        F.monotonically_increasing_id().alias("tag"), pages[id].cast("long").alias("page_id"),
        pages[url].alias("url"), pages[html].alias("html"))
        .withColumn("sha1", F.sha1(whole)).withColumn("size", F.octet_length(whole)), "pages")
    rank = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "tag")
    groups = (stored.where(F.col("size") >= least_bytes).groupBy("sha1", "size")
              .agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1")
              .select("sha1", "size", F.col("first.page_id").alias("refers_to"),
                      F.col("first.tag").alias("refers_tag")))
    other = F.col("refers_tag") != F.col("tag")
    rows = stored.join(groups, ["sha1", "size"], "left").select(
        "page_id", "tag", "url", "html", "sha1", F.when(other, F.col("refers_to")).alias("refers_to"),
        F.when(other, F.col("refers_tag")).alias("refers_tag"))
    sample = (stored.orderBy("sha1", "tag").limit(SAMPLES)
              .select("page_id", "tag", "url", F.substring("html", 1, SAMPLE_BYTES), "sha1"))
    dictionary = train([record(i, t, u, (h or "").encode(), s, None, None)
                        for i, t, u, h, s in sample.collect()])
    with shuffles_removed(spark):
        (rows.mapInArrow(lambda batches: _frames(batches, dictionary), "value binary")
         .select(F.col("value").cast("string")).write.option("lineSep", EMPTY_FRAME).text(path))
    discard(stored)


def records(content: bytes) -> Iterator[dict]:
    """The records of a file, each payload held against its digest."""
    known = None
    if len(content) >= 8 and struct.unpack_from("<I", content)[0] == DICTIONARY_FRAME:
        size = struct.unpack_from("<I", content, 4)[0]
        known = zstandard.ZstdCompressionDict(content[8:8 + size])
    stream = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=known).stream_reader(
        io.BytesIO(content), read_across_frames=True), 1 << 20)
    while version := stream.readline():
        if version != b"WARC/1.1\r\n":
            raise ValueError("not a WARC record")
        head = _fields(stream)
        block = stream.read(int(head["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a WARC record is cut short")
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(_fields(io.BytesIO(http + b"\r\n\r\n"))["Content-Length"])
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        revisit = head["WARC-Type"] == "revisit"
        if not revisit:
            found = base32(hashlib.sha1(payload).digest())
            if (len(payload), found) != (size, digest):
                raise ValueError("a payload does not match its digest")
        yield {"page_id": _number(head.get("WARC-Page-ID")), "url": head.get("WARC-Target-URI"),
               "record_type": head["WARC-Type"], "payload_bytes": size,
               "payload_digest": digest,
               "refers_to": _number(head.get("WARC-Refers-To-Page-ID")),
               "payload": None if revisit else payload}


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _fields(stream) -> dict[str, str]:
    found = {}
    while (line := stream.readline().rstrip(b"\r\n")):
        name, _, value = line.decode().partition(":")
        found[name] = value.strip()
    return found


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below `path`; a file is read by one task, a few
    records at a time."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("refers_to", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for found in records(content.as_py()):
                    held.append(found)
                    size += len(found["payload"] or b"")
                    if size >= 8 << 20 or len(held) >= 5000:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(of, COLUMNS)
