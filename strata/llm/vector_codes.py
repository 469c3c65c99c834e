"""Vectors as short codes: codebooks per part, entries found by slice-and-intersect bitmasks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import discard, in_batches, stage
from strata.llm.vectors import integers, matrix, extent

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
WORD = 64  # entries that one mask tells apart
ROWS = 8192  # vectors looked up at a time


class Slices:
    """Up to 64 entries of a codebook. Per dimension their coordinates in order, and for each
    place in that order the mask of the entries before it: the entries within a range of the
    dimension are the exclusive-or of two masks."""

    def __init__(self, entries: np.ndarray, first: int) -> None:
        self.entries, self.first = entries, first
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(entries, order, axis=0).T)
        bits = np.left_shift(np.uint64(1), order.T.astype(np.uint64))
        self.before = np.zeros((entries.shape[1], len(entries) + 1), np.uint64)
        self.before[:, 1:] = np.bitwise_or.accumulate(bits, axis=1)
        self.order = order

    def guess(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each point, of the entries nearest in one dimension, the nearest of all, and its
        squared distance."""
        code = best = None
        for k, row in enumerate(self.sorted):
            value = points[:, k]
            above = np.searchsorted(row, value).clip(0, len(row) - 1)
            below = (above - 1).clip(0)
            nearer = np.where(value - row[below] <= row[above] - value, below, above)
            found = self.order[nearer, k]
            gap = ((points - self.entries[found]) ** 2).sum(1)
            if best is None:
                code, best = found, gap
            else:
                better = gap < best
                code[better], best[better] = found[better], gap[better]
        return code, best

    def within(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries no dimension of which is further off than the radius. None
        nearer than the radius is missed."""
        found = np.full(len(points), np.iinfo(np.uint64).max, np.uint64)
        for k, row in enumerate(self.sorted):
            low = np.searchsorted(row, points[:, k] - radius, "left")
            high = np.searchsorted(row, points[:, k] + radius, "right")
            found &= self.before[k][high] ^ self.before[k][low]
        return found


def _root(squares: np.ndarray) -> np.ndarray:
    """The integer part of square roots, exactly."""
    root = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    root -= root * root > squares
    return root + ((root + 1) * (root + 1) <= squares)


def nearest(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each point the index of the nearest entry (squared distance, ties to the lower index)
    and that distance. A guess gives the radius, the masks of all dimensions ANDed the entries
    that can be as near, and only these are measured."""
    code = best = None
    for first in range(0, len(book), WORD):
        part = Slices(book[first:first + WORD], first)
        if best is None:
            code, best = part.guess(points)
        masks = part.within(points, _root(best))
        for k in range(len(part.entries)):
            rows = np.flatnonzero(masks >> np.uint64(k) & np.uint64(1))
            if len(rows):
                gap = ((points[rows] - part.entries[k]) ** 2).sum(1)
                entry = first + k
                better = (gap < best[rows]) | ((gap == best[rows]) & (entry < code[rows]))
                code[rows[better]], best[rows[better]] = entry, gap[better]
    return code, best


def _coded(batches: Iterator[pa.RecordBatch], books: np.ndarray, at: int
           ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Batches with their vectors cut into parts, and each part's code and error."""
    parts, _, width = books.shape
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            rows = batch.slice(k, ROWS)
            cut = matrix(rows.column(at), parts * width).reshape(-1, parts, width)
            found = [nearest(np.ascontiguousarray(cut[:, p]), books[p]) for p in range(parts)]
            yield (rows, cut, np.stack([c for c, _ in found], 1),
                   np.stack([e for _, e in found], 1))


def _sums(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row per part and entry that a task's vectors chose: how many did, and their sum."""
    parts, entries, width = books.shape
    sums, counts = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
    for _, cut, codes, _ in _coded(batches, books, 0):
        for p in range(parts):
            counts[p] += np.bincount(codes[:, p], minlength=entries)
            order = np.argsort(codes[:, p], kind="stable")
            used, starts = np.unique(codes[order, p], return_index=True)
            sums[p, used] += np.add.reduceat(cut[order, p], starts, axis=0)
    part, entry = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)),
         pa.array(counts[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))],
        ["part", "entry", "n", "sums"])


def _moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after a round: each entry is the mean, rounded down, of the parts that chose
    it; entries that none chose stay. The driver gets one row per component of the codebooks."""
    found = in_batches(rows).select("ints").mapInArrow(
        lambda batches: _sums(batches, books), "part int, entry int, n long, sums array<long>")
    cells = found.select("part", "entry", "n", F.posexplode("sums").alias("place", "sum"))
    after = books.copy()
    for part, entry, place, n, total in cells.groupBy("part", "entry", "place").agg(
            F.sum("n"), F.sum("sum")).collect():
        after[part, entry, place] = total // n
    return after


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
          ) -> np.ndarray:
    """Codebooks (part, entry, component) of integer vectors, from the `entries` least ids on;
    of rows that repeat an id the one with the least vector comes first, null ids come last."""
    size, peak = extent(rows)
    width = max(1, -(-size // parts))
    if width * (2 * peak) ** 2 >= 1 << 62:
        raise ValueError("squared distances of these vectors are beyond 64 bits")
    first = rows.select("vec_id", "ints").orderBy(F.col("vec_id").isNull(), "vec_id", "ints").limit(
        entries).collect()
    books = matrix(pa.array([x[1] for x in first], pa.binary()), parts * width).reshape(
        len(first), parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds if first else 0):
        books = _moved(rows, books)
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def assign(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of integer vectors: two hex digits per part, and the squared
    distances to the chosen entries, added up."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, codes, errors in _coded(batches, books, 2):
            text = codes.astype(np.uint8).tobytes().hex()
            wide = 2 * codes.shape[1]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1),
                 pa.array([text[k:k + wide] for k in range(0, len(text), wide)], pa.string()),
                 pa.array(errors.sum(1))], ["vec_id", "label", "code", "error"])

    kinds = [rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    return in_batches(rows).select("vec_id", "label", "ints").mapInArrow(
        of, f"vec_id {kinds[0]}, label {kinds[1]}, code string, error long")


def vector_codes(df: DataFrame, id: str = "vec_id", vector: str = "embedding",
                 label: str = "label", scale: int = SCALE, parts: int = PARTS,
                 entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of df with a vector: vec_id, code, error, label_error, codebooks_sha256.

    Rows whose vector is null or holds a null or a component that is not finite are left out.
    Components become floor(scale * x). Vectors are cut into `parts` equal parts; shorter ones
    count as filled up with zeros to the longest, and all to a multiple of `parts`. Every part
    position has a codebook of up to `entries` (256 at most; fewer if there are fewer rows),
    trained by `rounds` rounds over all rows. label_error adds up the error over rows of the same
    label, null labels together. Null ids are coded like others and train like them; repeated
    rows are each returned. Other columns are not looked at; an empty table gives an empty
    result. Components beyond 32 bits are an error.

    Each round is one pass over the integer vectors without a shuffle of them: a task sends its
    sums, a row per part and entry."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits per part, so 256 entries at most")
    rows = stage(integers(df, scale, id, vector, df[label]), "vectors")
    books = train(rows, parts, entries, rounds)
    kinds = [rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    if not books.shape[1]:
        discard(rows)
        return df.sparkSession.createDataFrame(
            [], f"vec_id {kinds[0]}, code string, error long, label_error long, "
            "codebooks_sha256 string")
    coded = stage(assign(rows, books), "vector-codes")
    discard(rows)
    totals = stage(coded.groupBy(F.col("label").alias("of")).agg(
        F.sum("error").alias("label_error")), "label-errors")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
