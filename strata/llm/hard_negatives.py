"""Hard negatives by exact scores: products modulo small primes in float32, put together by the
Chinese remainder theorem, then windowed selection."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import discard, in_batches, stage
from strata.llm.vectors import extent, integers, matrix
from strata.session import scratch_path

SCALE, POSITIVES, NEGATIVES = 256, 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
EXACT = 1 << 24  # whole numbers up to here are exact in float32
MOST_SCORE = 1 << 53
BLOCK_BYTES, BLOCK = 8 << 20, 4096  # anchors broadcast at a time
CELLS = 1 << 20  # scores held at a time
SAMPLE = 16  # one row in so many sets the first bounds
PRIMES = [p for p in range(255, 100, -1) if all(p % q for q in range(2, 16))]
LEAST = -(1 << 62)


class Residues:
    """A matrix modulo several primes, in float32 and around zero. Products are exact as long as
    a sum of (prime / 2) ** 2 stays within EXACT, so wide matrices are multiplied in strips."""

    def __init__(self, values: np.ndarray, primes: list[int]) -> None:
        self.primes = primes
        self.parts = [((values + p // 2) % p - p // 2).astype(np.float32) for p in primes]

    def times(self, other: Residues) -> np.ndarray:
        """self x other transposed, exactly, if the product of the primes is beyond twice the
        largest score."""
        whole = math.prod(self.primes)
        kind = np.int32 if whole < 1 << 30 else np.int64
        score, reach = None, 1
        for k, p in enumerate(self.primes):
            a, b = self.parts[k], other.parts[k]
            strip = EXACT // (p // 2) ** 2
            found = np.zeros((len(a), len(b)), kind)
            for at in range(0, a.shape[1], strip):
                found += (a[:, at:at + strip] @ b[:, at:at + strip].T).astype(kind) % p
            # The next digit in the mixed base of the primes so far.
            if score is None:
                score = found % p
            else:
                digit = (found - score) % p * pow(reach, -1, p) % p
                score += digit * kind(reach)
            reach *= p
        score[score > whole // 2] -= kind(whole)
        return score


def primes_for(width: int, peak: int) -> list[int]:
    """Three primes or more whose product exceeds twice the largest score that vectors of this
    width and largest component can have."""
    most = width * peak * peak
    if most >= MOST_SCORE:
        raise ValueError("scores of these vectors are beyond 53 bits")
    count = 3
    while math.prod(PRIMES[:count]) <= 2 * most + 1:
        count += 1
    return PRIMES[:count]


@dataclass
class Wanted:
    """What a pass looks for: per window an anchor (its place in the block) and the scores it
    takes, ends included. A score equal to the low end counts only with an id below low_id."""

    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray
    low_id: np.ndarray
    same: bool  # rows of the anchor's label, or of any other
    count: int


@dataclass
class Anchors:
    ids: np.ndarray
    labels: np.ndarray
    values: np.ndarray


class Best:
    """The first `count` finds of each window: higher scores first, then smaller ids."""

    def __init__(self, wanted: Wanted) -> None:
        self.count = wanted.count
        self.low, self.low_id = wanted.low.copy(), wanted.low_id.copy()
        self.held = [np.zeros(0, np.int64)] * 3
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, window: np.ndarray, score: np.ndarray, id: np.ndarray) -> None:
        self.waiting.append((window, score, id))
        self.size += len(window)
        if self.size > max(CELLS // 4, len(self.held[0])):
            self.settle()

    def settle(self) -> None:
        if not self.waiting:
            return
        window, score, id = (np.concatenate(x) for x in zip(self.held, *self.waiting, strict=True))
        order = np.lexsort((id, -score, window))
        window, score, id = window[order], score[order], id[order]
        starts = np.flatnonzero(np.r_[True, window[1:] != window[:-1]])
        rank = np.arange(len(window)) - np.repeat(starts, np.diff(np.r_[starts, len(window)]))
        keep = rank < self.count
        self.held = [window[keep], score[keep], id[keep]]
        last = rank == self.count - 1
        self.low[window[last]], self.low_id[window[last]] = score[last], id[last]
        self.waiting, self.size = [], 0


def _search(batches: Iterator[pa.RecordBatch], anchors: Anchors, wanted: Wanted,
            primes: list[int]) -> Iterator[pa.RecordBatch]:
    """The best of a task's rows (vec_id, label, ints) in each window."""
    best, width = Best(wanted), anchors.values.shape[1]
    left = Residues(anchors.values, primes)
    of = wanted.anchor
    owner, label = anchors.ids[of][:, None], anchors.labels[of][:, None]
    tall = max(1, CELLS // max(1, len(of), len(anchors.ids)))
    for batch in batches:
        ids, labels = (batch.column(k).to_numpy() for k in range(2))
        for at in range(0, batch.num_rows, tall):
            part = slice(at, at + tall)
            rows = Residues(matrix(batch.column(2).slice(at, tall), width), primes)
            scores = left.times(rows)[of]
            fits = ((scores >= best.low[:, None]) & (scores <= wanted.high[:, None])
                    & ((label == labels[part]) == wanted.same))
            window, row = np.nonzero(fits)
            score, id = scores[window, row].astype(np.int64), ids[part][row]
            keep = (id != owner[window, 0]) & (
                (score > best.low[window]) | (id < best.low_id[window]))
            if keep.any():
                best.add(window[keep], score[keep], id[keep])
    best.settle()
    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in best.held],
                                     ["window", "score", "id"])


def _found(rows: DataFrame, anchors, wanted: Wanted, primes: list[int]) -> DataFrame:
    """(window, score, id, rank) of the first finds of each window over all rows. A task sends no
    more than a window asks for."""
    looked = in_batches(rows).mapInArrow(
        lambda batches: _search(batches, anchors.value, wanted, primes),
        "window long, score long, id long")
    first = Window.partitionBy("window").orderBy(F.desc("score"), "id")
    return looked.withColumn("rank", F.row_number().over(first)).where(
        F.col("rank") <= wanted.count)


def _bounded(sample: DataFrame, anchors, wanted: Wanted, primes: list[int]) -> Wanted:
    """The same windows with low ends raised to what a sample of the rows already fills them
    with. No row below can be among the first, so tasks over all rows send few."""
    last = _found(sample, anchors, wanted, primes).where(
        F.col("rank") == wanted.count).select("window", "score", "id").collect()
    low, low_id = wanted.low.copy(), wanted.low_id.copy()
    for window, score, id in last:
        low[window], low_id[window] = score, id + 1  # the last one itself still counts
    return Wanted(wanted.anchor, low, wanted.high, low_id, wanted.same, wanted.count)


def _windows(positives: list, n: int, low: int, high: int, count: int) -> Wanted:
    score = np.array([x["score"] for x in positives], np.int64)
    return Wanted(np.array([x["window"] for x in positives], np.int64),
                  -(-low * score // 100), high * score // 100,
                  np.full(len(score), np.iinfo(np.int64).max), False, count)


def _blocks(anchors: DataFrame, width: int) -> Iterator[list]:
    """The anchors in order of id, so many at a time that a block has a bounded size."""
    size, last = max(1, min(BLOCK, BLOCK_BYTES // (8 * max(1, width)))), None
    while True:
        rest = anchors if last is None else anchors.where(F.col("vec_id") > last)
        block = rest.orderBy("vec_id").limit(size).collect()
        if not block:
            return
        yield block
        last = block[-1]["vec_id"]


def _mined(spark: SparkSession, rows: DataFrame, sample: DataFrame, block: list, width: int,
           primes: list[int], positives: int, negatives: int, low: int, high: int
           ) -> DataFrame | None:
    """The result for one block of anchors: their positives, then the negatives of each."""
    ids = np.array([x["vec_id"] for x in block], np.int64)
    shared = spark.sparkContext.broadcast(Anchors(
        ids, np.array([x["label"] for x in block], np.int64),
        matrix(pa.array([x["ints"] for x in block], pa.binary()), width)))
    n, top = len(block), np.iinfo(np.int64).max
    wanted = Wanted(np.arange(n), np.full(n, LEAST), np.full(n, top), np.full(n, top), True,
                    positives)
    partners = _found(rows, shared, _bounded(sample, shared, wanted, primes), primes).orderBy(
        "window", "rank").collect()  # so many per anchor of the block
    if not partners:
        return None
    wanted = _bounded(sample, shared, _windows(partners, n, low, high, negatives), primes)
    pairs = spark.createDataFrame(
        [(k, int(ids[x["window"]]), x["id"], x["score"]) for k, x in enumerate(partners)],
        "pair long, anchor_id long, positive_id long, positive_score long")
    found = _found(rows, shared, wanted, primes)
    return found.join(F.broadcast(pairs), F.col("window") == F.col("pair")).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
          "negative_score long")


def hard_negatives(df: DataFrame, anchor: Column, id: str = "vec_id", vector: str = "embedding",
                   label: str | Column = "label", scale: int = SCALE,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
                   high: int = HIGH) -> DataFrame:
    """For each row for which `anchor` (a condition on vec_id) holds and each of its positives,
    the first `positives` other rows of its label, the first `negatives` rows of other labels
    whose score is from `low` to `high` percent of the positive's: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.

    A score is the inner product of the components floor(scale * x), exact; higher scores come
    first, ties by smaller id. Rows with a null id or label, or a vector that is null or holds a
    null or a component that is not finite, take no part. Shorter vectors count as filled up with
    zeros. Rows of the anchor's own id are not its partners; of anchors that repeat an id the one
    with the least label and vector is taken, other repeated rows are each partners. A negative
    positive's score admits no negatives, as its window is empty. Other columns are not looked
    at; an empty table, or one without anchors, gives an empty result. Scores beyond 53 bits are
    an error.

    Anchors meet the rows block by block: a block of bounded size is broadcast, and the rows are
    read in place, without a shuffle of vectors. A pass over one row in 16 first bounds what the
    passes over all rows need to send."""
    spark = df.sparkSession
    group = df[label] if isinstance(label, str) else label
    whole = integers(df, scale, id, vector, group.cast("long"))
    rows = stage(whole.where("vec_id IS NOT NULL AND label IS NOT NULL").withColumn(
        "vec_id", F.col("vec_id").cast("long")), "mining-rows")
    width, peak = extent(rows)
    primes = primes_for(width, peak)
    fields = ["vec_id", "label", "ints"]
    sample = stage(rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(SAMPLE)) == 0).select(*fields),
                   "mining-sample")
    anchors = stage(rows.where(anchor).groupBy("vec_id").agg(
        F.min(F.struct("label", "ints")).alias("first")).select("vec_id", "first.*"),
        "mining-anchors")
    path = scratch_path(spark, "hard-negatives")
    spark.createDataFrame([], RESULT).write.parquet(path)
    for block in _blocks(anchors, width):
        found = _mined(spark, rows.select(*fields), sample, block, width, primes, positives,
                       negatives, low, high)
        if found is not None:
            found.write.mode("append").parquet(path)
    for staged in (rows, sample, anchors):
        discard(staged)
    return spark.read.schema(RESULT).parquet(path)
