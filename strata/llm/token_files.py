"""Token ids in binary files: range-ordered, entropy-coded blocks that decode independently.

A file is a row of records, each `kind, length, body, crc of the body, newline`:
  BLK  a block of ids (see rans)
  DOC  ids and lengths of documents whose ids lie in the blocks, in order
  END  the number of documents and of ids in the file
Spark's text writer writes the records, so the files go to any file system that Spark reaches.
The frequency table that all blocks share lies beside them."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import rans
from strata.llm.common import discard, shuffles_removed, stage
from strata.llm.tokens import encode, encoder

RECORD = struct.Struct("<4sQ")
END_SIZE = RECORD.size + 16 + 5
FILE_IDS = 8 << 20
GROUP = rans.BLOCK * 16


def _record(kind: bytes, body: bytes) -> bytes:
    return RECORD.pack(kind, len(body)) + body + struct.pack("<I", zlib.crc32(body))


def _records(content: bytes) -> Iterator[tuple[bytes, memoryview]]:
    view, at = memoryview(content), 0
    while at < len(view):
        kind, size = RECORD.unpack_from(view, at)
        body = view[at + RECORD.size:at + RECORD.size + size]
        at += RECORD.size + size
        if struct.unpack_from("<I", view, at)[0] != zlib.crc32(body):
            raise ValueError("a record does not match its checksum")
        at += 5
        yield kind, body


def _ids_in(tail: bytes) -> int:
    """How many ids a file holds, from its last record."""
    (_, body), = _records(tail)
    return struct.unpack("<QQ", body)[1]


def _doc_record(ids: list, lengths: list) -> bytes:
    null = np.array([x is None for x in ids], np.uint8)
    plain = np.array([x or 0 for x in ids], "<i8")
    return _record(b"DOC ", struct.pack("<Q", len(ids)) + null.tobytes() + plain.tobytes()
                   + np.array(lengths, "<i8").tobytes())


def _file(batches: Iterator[pa.RecordBatch], width: np.dtype, table: rans.Table
          ) -> Iterator[pa.RecordBatch]:
    """The records of one file from its rows (doc_id, n_tokens, ids), a few blocks at a time."""
    waiting: list[np.ndarray] = []
    held = docs = total = 0
    row = lambda x: pa.RecordBatch.from_arrays([pa.array([x], pa.binary())], ["value"])

    def flush(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal waiting, held
        ids = np.concatenate(waiting) if waiting else np.zeros(0, width)
        cut = len(ids) if last else len(ids) // rans.BLOCK * rans.BLOCK
        for at in range(0, cut, GROUP):
            for block in rans.encode(ids[at:min(at + GROUP, cut)], table):
                yield row(_record(b"BLK ", block))
        waiting, held = [ids[cut:].copy()], len(ids) - cut

    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            names, lengths = part.column(0).to_pylist(), part.column(1).to_pylist()
            for value in part.column(2):
                waiting.append(np.frombuffer(value.as_buffer(), width))
                held += len(waiting[-1])
                if held >= GROUP:
                    yield from flush(False)
            docs, total = docs + len(names), total + sum(lengths)
            yield row(_doc_record(names, lengths))
    if docs:
        yield from flush(True)
        yield row(_record(b"END ", struct.pack("<QQ", docs, total)))


def write_tokens(docs: DataFrame, vocabulary: str, path: str, end: int | None = None,
                 id: str = "doc_id", text: str = "text", file_ids: int = FILE_IDS) -> None:
    """Write the ids of every row of docs below `path`, in ascending order of id, each followed
    by `end`. Null text counts as empty; null ids come first; rows that share an id follow each
    other. Other columns are not looked at. An empty table gives no file.

    Texts are encoded once; the ids wait in a staged table while their frequencies are counted
    (one number per vocabulary entry and task reaches the shuffle, the vocabulary's the driver).
    A file holds about `file_ids` ids, so its reader's memory is bounded."""
    spark, known = docs.sparkSession, encoder(vocabulary)
    width, size = known.dtype, known.tokenizer.get_vocab_size()
    if end is not None and end >= size:
        raise ValueError(f"the vocabulary has no id {end}")
    staged = stage(encode(docs, vocabulary, end, id, text), "token-ids")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                ids = batch.column(0).slice(at, 1000).cast(pa.large_binary())
                ends = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset:][:len(ids) + 1]
                total += np.bincount(np.frombuffer(ids.buffers()[2], np.uint8)[
                    ends[0]:ends[-1]].view(width), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["token", "n"])

    counted = staged.select("ids").mapInArrow(count, "token long, n long")
    counts = np.zeros(size, np.int64)
    for token, n in counted.groupBy("token").agg(F.sum("n")).collect():
        counts[token] = n
    table = rans.Table.of(counts)
    spark.createDataFrame([(int(i), int(table.freq[i])) for i in np.flatnonzero(table.freq)],
                          "token long, freq long").coalesce(1).write.parquet(f"{path}/table")
    order = [F.col("doc_id"), F.xxhash64("ids")]
    files = max(1, -(-int(counts.sum()) // file_ids))
    with shuffles_removed(spark):
        (staged.repartitionByRange(files, *order).sortWithinPartitions(*order)
         .mapInArrow(lambda batches: _file(batches, width, table), "value binary")
         .select(F.col("value").cast("string"))
         .write.option("lineSep", "\n").text(f"{path}/blocks"))
    discard(staged)


def _table(spark: SparkSession, path: str, bits: int = rans.BITS) -> rans.Table:
    rows = spark.read.schema("token long, freq long").parquet(f"{path}/table").collect()
    freq = np.zeros(max((r.token for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        freq[r.token] = r.freq
    return rans.Table(freq, bits)


def manifest(spark: SparkSession, path: str) -> dict[str, tuple[int, int]]:
    """By file, in the order of ids: how many ids lie before it, and how many in it."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [_ids_in(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64())], ["path", "n"])

    rows = (spark.read.format("binaryFile").load(f"{path}/blocks")
            .where("length > 0")
            .select("path", F.expr(f"substring(content, length - {END_SIZE - 1}, {END_SIZE})"))
            .mapInArrow(ends, "path string, n long").collect())
    found, before = {}, 0
    for name, n in sorted(rows, key=lambda r: int(r[0].rsplit("/part-", 1)[1].split("-")[0])):
        found[name] = before, n
        before += n
    return found


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row (doc_id, start, n_tokens, ids) per document written: start counts the ids of all
    documents before it; ids are little-endian unsigned 32-bit. A file is decoded by one task,
    all its blocks and checkpoints side by side, and every checksum is compared."""
    table, files = _table(spark, path), manifest(spark, path)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield from documents(content.as_buffer(), table, files[name][0])

    return (spark.read.format("binaryFile").load(f"{path}/blocks").select("path", "content")
            .mapInArrow(of, "doc_id long, start long, n_tokens long, ids binary"))


def documents(content: bytes, table: rans.Table, base: int = 0) -> Iterator[pa.RecordBatch]:
    blocks, parts = [], []
    for kind, body in _records(content):
        if kind == b"BLK ":
            blocks.append(body)
        elif kind == b"DOC ":
            n = struct.unpack_from("<Q", body)[0]
            parts.append((np.frombuffer(body, np.uint8, n, 8),
                          np.frombuffer(body, "<i8", n, 8 + n),
                          np.frombuffer(body, "<i8", n, 8 + n * 9)))
    ids, at = rans.decode(blocks, table).astype("<u4"), 0
    for null, names, lengths in parts:
        ends = at + np.cumsum(lengths)
        starts = ends - lengths
        yield pa.RecordBatch.from_arrays([
            pa.array(names, pa.int64(), mask=null.astype(bool)), pa.array(starts + base),
            pa.array(lengths),
            pa.array([ids[a:b].tobytes() for a, b in zip(starts, ends, strict=True)],
                     pa.binary())], ["doc_id", "start", "n_tokens", "ids"])
        at = int(ends[-1]) if len(ends) else at
