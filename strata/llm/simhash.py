"""SimHash near duplicates: fingerprints, and all pairs within a few bits by tiled comparison."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (discard, discard_all, in_batches, join_hot, left_in_place, noted,
                               stage, stage_in_place)
from strata.llm.components import components

WORDS, RADIUS, SEED = 3, 2, 42
CELLS = 1 << 20  # comparisons at a time
FULL = 200_000  # fingerprints of a tile that one task holds
PART = 1 << 15  # shingles at a time


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """A bit is 1 if it is set in over half the XXH64 hashes (seed 42) of the text's shingles:
    `words` words in a row, space-joined, repeats included; of fewer words the whole sequence;
    of none the fingerprint is 0. A-Z are lower-cased; words end at ASCII white space."""
    from xxhash import xxh64_digest

    found = (text or "").encode().lower().split()
    if not found:
        return 0
    whole, n = b" ".join(found), max(1, len(found) - words + 1)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = (ends - [len(w) + 1 for w in found])[:n].tolist()
    stops = (ends - 1)[min(words, len(found)) - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, PART):
        hashes = np.frombuffer(b"".join([
            xxh64_digest(whole[a:b], SEED) for a, b in
            zip(starts[at:at + PART], stops[at:at + PART], strict=True)]), ">u8").astype("<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text",
                 words: int = WORDS) -> DataFrame:
    """One row (doc_id, print) per row of docs; print holds the 64 bits as a signed long."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "print"])

    return in_batches(docs).select(docs[id].alias("doc_id"), docs[text].alias("text")).mapInArrow(
        of, f"doc_id {docs.schema[id].dataType.simpleString()}, print long")


def _steps(parts: int, radius: int) -> list[tuple[int, ...]]:
    """How the population counts of two fingerprints within the radius may differ, part by part:
    by `radius` in all at most. Of a difference and its opposite only one is listed."""
    around = product(range(-radius, radius + 1), repeat=parts) if parts <= 4 else _sparse(
        parts, radius)
    return sorted({s for s in around if sum(map(abs, s)) <= radius and s > (0,) * parts})


def _sparse(parts: int, radius: int) -> Iterator[tuple[int, ...]]:
    def grow(at: int, left: int) -> Iterator[tuple[int, ...]]:
        if at == parts:
            yield ()
            return
        for d in range(-left, left + 1):
            for rest in grow(at + 1, left - abs(d)):
                yield (d, *rest)

    return grow(0, radius)


class Forest:
    """Which of the pairs seen so far are already connected."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def root(self, x):
        up = self.parent.setdefault(x, x)
        while up != self.parent[up]:
            self.parent[x] = self.parent[up]
            x, up = up, self.parent[up]
        return up

    def join(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _links(home: np.ndarray, others: np.ndarray, radius: int, same: bool
           ) -> Iterator[tuple[int, int]]:
    """Pairs of a tile's fingerprints with others within the radius, block by block."""
    wide = max(1, min(len(others), CELLS))
    tall = max(1, CELLS // wide)
    for i in range(0, len(home), tall):
        for j in range(0, len(others), wide):
            if same and j + wide <= i:
                continue
            a, b = home[i:i + tall], others[j:j + wide]
            near = np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
            for p, q in zip(*np.nonzero(near), strict=True):
                if not same or i + p < j + q:
                    yield int(a[p]), int(b[q])


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows (tile, share, guest, print) come by tile and share, the share's own fingerprints
    first, then those of the tile's other shares and of the tiles around it. Only its own are
    held; of the links found the ones that join something are returned."""
    tile, home, forest = None, np.zeros(0, np.uint64), Forest()
    for batch in batches:
        tiles, shares, guest, prints = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        prints = prints.view(np.uint64)
        cuts = np.flatnonzero((np.diff(tiles) != 0) | (np.diff(shares) != 0)
                              | (np.diff(guest) != 0)) + 1
        found: list[tuple[int, int]] = []
        for a, b in zip([0, *cuts], [*cuts, len(tiles)], strict=True):
            if a == b:
                continue
            if (tiles[a], shares[a]) != tile:
                tile, home, forest = (tiles[a], shares[a]), np.zeros(0, np.uint64), Forest()
            part = prints[a:b]
            if guest[a]:
                pairs = _links(home, part, radius, False) if len(home) else ()
                found += [x for x in pairs if forest.join(*x)]
            else:
                found += [x for x in _links(home, part, radius, False) if forest.join(*x)] if len(
                    home) else []
                found += [x for x in _links(part, part, radius, True) if forest.join(*x)]
                home = np.concatenate([home, part])
        if found:
            ends = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])],
                                             ["a", "b"])


def parts_for(prints: int) -> int:
    """Into how many parts fingerprints are cut for so many of them: more parts make more and
    smaller tiles, and more copies of each fingerprint."""
    return 4 if prints <= 10_000_000 else 8 if prints <= 10_000_000_000 else 16


def links(prints: DataFrame, radius: int = RADIUS, parts: int | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints at most `radius` bits apart, enough of them to
    connect all that are; `prints` has one row per distinct fingerprint in column print.

    A tile holds the fingerprints whose `parts` equal parts have the same population counts.
    Two fingerprints within the radius have counts that differ by no more than it, all parts
    added; tiles further apart are never compared, the others exactly, by exclusive-or and bit
    counts. parts (4, 8 or 16) follows from the number of fingerprints if it is None; the result
    is the same. A tile of more than FULL fingerprints is dealt to several tasks: each holds a
    share of them and sees all others as guests."""
    prints = prints.select("print")
    total = prints.count()
    parts = parts or parts_for(total)
    bits, size = 64 // parts, 64 // parts + 1
    counts = [F.bit_count(F.shiftrightunsigned("print", bits * k).bitwiseAND(
        F.lit((1 << bits) - 1 if bits < 64 else -1))).cast("long") for k in range(parts)]
    number = lambda c: sum((x * size ** k for k, x in enumerate(c)), F.lit(0).cast("long"))
    tiled = prints.withColumn("home", number(counts))
    # Fewer than total / FULL tiles are full.
    full = F.broadcast(tiled.groupBy("home").agg(F.count("*").alias("n")).where(
        F.col("n") > FULL).select(F.col("home").alias("tile"),
                                  F.ceil(F.col("n") / FULL).cast("int").alias("shares")))
    around = [F.struct(F.when(
        F.array_min(F.array(*to, F.lit(0).cast("long"))).eqNullSafe(0)
        & (F.array_max(F.array(*to, F.lit(0).cast("long"))) <= bits),
        number(to)).alias("tile"), F.lit(1).alias("guest"))
        for step in _steps(parts, radius)
        for to in [[c + d for c, d in zip(counts, step, strict=True)]]]
    home = F.struct(F.col("home").alias("tile"), F.lit(0).alias("guest"))
    # Fingerprints are few bytes and become many rows, so they are dealt out before.
    spread = (prints.repartition(_tasks(prints), "print").withColumn("home", number(counts))
              .select("print", F.explode(F.array(home, *around)).alias("at"))
              .where("at.tile IS NOT NULL").select("at.tile", "at.guest", "print"))
    share = F.pmod(F.xxhash64("print"), F.col("shares")).cast("int")
    # A full tile's own fingerprints are at home in one share and guests in those after it.
    dealt = (spread.join(full, "tile", "left")
        .withColumn("shares", F.coalesce("shares", F.lit(1)))
        .withColumn("own", F.when(F.col("guest") == 0, share))
        .withColumn("share", F.explode(F.sequence(
            F.coalesce("own", F.lit(0)), F.col("shares") - 1)))
        .select("tile", "share", "print", F.when(F.col("guest") == 1, 1).otherwise(
            (F.col("share") != F.col("own")).cast("int")).alias("guest")))
    return (dealt.select("tile", "share", "guest", "print").repartition("tile", "share")
            .sortWithinPartitions("tile", "share", "guest").mapInArrow(
                lambda batches: _compare(batches, radius), "a long, b long"))


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def simhash_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS,
                   radius: int = RADIUS, parts: int | None = None) -> DataFrame:
    """One row (doc_id, print, component_id) per row of docs. Fingerprints at most `radius` bits
    apart are linked; component_id is the least id reachable over links, the row's own included.

    Null and empty texts have fingerprint 0, which is linked like any other. Null ids are passed
    over when the least is sought (null if all are null); repeated rows are each returned. Other
    columns are not looked at; an empty table gives an empty result.

    Equal fingerprints are one before any comparison, so a group of exact copies costs a row per
    task. Links, components and fingerprints stay in tables."""
    seen = stage(fingerprints(docs, id, text, words), "prints")
    distinct = stage(seen.groupBy("print").agg(F.min("doc_id").alias("first"),
                                               F.count("*").alias("n")), "prints-distinct")
    near = stage(links(distinct, radius, parts), "links")
    roots = stage(components(near), "roots")
    discard(near)
    named = distinct.join(roots, distinct["print"] == roots["node"], "left").select(
        "print", F.coalesce("root", "print").alias("root"), "first", "n")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = named.join(least, "root").select("print", "component_id", "n")
    return join_hot(seen, stage(classes, "print-classes"), ["print"], seen.count()).select(
        "doc_id", "print", "component_id")


def simhash_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS,
                  radius: int = RADIUS, parts: int | None = None) -> DataFrame:
    """The rows of docs, all columns kept, without those whose group has one that stays: of each
    group the row with the least id, null ids last. Of rows that repeat the least id one stays.
    Null and empty texts are alike; an empty table gives an empty one. Texts are read where they
    lie and not shuffled; what was stored on the way is removed."""
    with noted() as folders:
        rows = stage_in_place(docs.select(F.col(id).alias("doc_id"), F.struct(
            *[docs[c] for c in docs.columns]).alias("row")), "simhash-rows")
        key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "part", "tag")
        tagged = rows.select(key.alias("key"), F.col("row").getField(text).alias("text"))
        gone = stage(simhash_groups(tagged, "key", "text", words, radius, parts).where(
            F.col("doc_id.tag") != F.col("component_id.tag")).select(
                "doc_id.part", "doc_id.tag"), "simhash-gone")
    kept = left_in_place(rows, gone, "left_anti", ["row"], "simhash-kept")
    discard_all(docs.sparkSession, folders)
    return kept.select("row.*")
