"""Vector bin packing of token sequences: tokens, segments and loss-bearing tokens at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from strata.llm.common import in_batches
from strata.llm.tokens import TEXTS, encoder, end_bytes

TOKENS, SEGMENTS = 1024, 64
POOL = 4096
COLUMNS = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
           "sequence_id long, offset long, loss_tokens long")


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold."""

    tokens: int = TOKENS
    segments: int = SEGMENTS
    loss: int = TOKENS


@dataclass
class Source:
    """A document: its ids, and up to each place how many of them bear loss."""

    name: object
    ids: np.ndarray
    loss: np.ndarray | None = None

    def loss_of(self, start: int, length: int) -> int:
        """Without a mask every id bears loss but the first of a segment, which nothing precedes."""
        if self.loss is None:
            return length - 1
        return int(self.loss[start + length] - self.loss[start])

    def longest(self, start: int, room: int, loss: int) -> int:
        """The most ids from `start` on that fit the room and bear no more loss than given."""
        room = min(room, len(self.ids) - start)
        if self.loss is None:
            return min(room, loss + 1)
        return min(room, int(np.searchsorted(self.loss, self.loss[start] + loss, "right"))
                   - 1 - start)


Piece = tuple[Source, int, int]


class Pool:
    """Waiting pieces by kind (tokens, loss), with the sizes and counts of kinds in arrays."""

    def __init__(self, limits: Limits, kinds: int) -> None:
        self.caps = np.array([limits.tokens, limits.segments, max(1, limits.loss)], float)
        self.slots: dict[tuple[int, int], int] = {}
        self.pieces: list[list[Piece]] = []
        self.sizes = np.ones((kinds, 3), np.int64)
        self.counts = np.zeros(kinds, np.int64)
        self.scaled = np.zeros((kinds, 3))
        self.weights, self.size = np.ones(3), 0

    def put(self, piece: Piece) -> None:
        kind = piece[2], piece[0].loss_of(*piece[1:])
        if kind not in self.slots:
            if len(self.pieces) == len(self.counts):
                self._compact()
            self.slots[kind] = len(self.pieces)
            self.sizes[len(self.pieces)] = kind[0], 1, kind[1]
            self.scaled[len(self.pieces)] = self.sizes[len(self.pieces)] / self.caps
            self.pieces.append([])
        slot = self.slots[kind]
        self.pieces[slot].append(piece)
        self.counts[slot] += 1
        self.size += 1

    def take(self, slot: int) -> Piece:
        self.counts[slot] -= 1
        self.size -= 1
        return self.pieces[slot].pop()

    def weigh(self) -> None:
        """A size weighs as much as all that waits asks for of it."""
        self.weights = (self.scaled * self.counts[:, None]).sum(0)

    def best(self, room: np.ndarray, exact: bool = False) -> int:
        """The slot of the largest dot product among those that fit, or -1. exact: only those
        that leave no token free."""
        fits = (self.counts > 0) & (self.sizes[:, 0] <= room[0]) & (self.sizes[:, 2] <= room[2])
        if exact:
            fits &= self.sizes[:, 0] == room[0]
        score = np.where(fits, self.scaled @ (self.weights * room / self.caps), -1.0)
        slot = int(score.argmax())
        return slot if fits[slot] else -1

    def longer(self, tokens: int) -> int:
        """A slot of pieces with more tokens than that, or -1."""
        over = (self.counts > 0) & (self.sizes[:, 0] > tokens)
        slot = int(over.argmax())
        return slot if over[slot] else -1

    def _compact(self) -> None:
        kept = [p for found in self.pieces for p in found]
        kinds = max(len(self.counts), 2 * int((self.counts > 0).sum()))
        self.__init__(Limits(*map(int, self.caps)), kinds)
        for piece in kept:
            self.put(piece)
        self.weigh()


class Packer:
    """Fills one sequence at a time from a pool of pieces: the next piece is the one whose
    sizes have the largest weighted dot product with the room that is left. With `cut`, a piece
    is cut where none fits or where only one segment is left, and a sequence that still comes
    out short is divided into powers of two, which need no padding."""

    def __init__(self, limits: Limits = Limits(), cut: bool = True, pool: int = POOL) -> None:
        self.limits, self.cut, self.most = limits, cut, pool
        self.pool = Pool(limits, 2 * pool)

    def add(self, source: Source) -> Iterator[list[Piece]]:
        if not self.cut:
            whole = source, 0, len(source.ids)
            if (len(source.ids) > self.limits.tokens
                    or source.loss_of(*whole[1:]) > self.limits.loss):
                yield [whole]
            elif len(source.ids):
                self.pool.put(whole)
        else:
            start = 0
            while start < len(source.ids):
                length = max(1, source.longest(start, self.limits.tokens, self.limits.loss))
                if length == self.limits.tokens:
                    yield [(source, start, length)]
                else:
                    self.pool.put((source, start, length))
                start += length
        if self.pool.size >= self.most:
            yield from self._fill(self.most // 2)

    def close(self) -> Iterator[list[Piece]]:
        yield from self._fill(0)

    def _fill(self, left: int) -> Iterator[list[Piece]]:
        self.pool.weigh()
        while self.pool.size > left:
            yield from self._finished(self._one())

    def _one(self) -> list[Piece]:
        pool, found = self.pool, []
        room = np.array([self.limits.tokens, self.limits.segments, self.limits.loss])
        while room[0] > 0 and room[1] > 0:
            slot = pool.best(room, exact=self.cut and room[1] == 1)
            if slot < 0 and self.cut and (longer := pool.longer(room[0])) >= 0:
                source, start, length = pool.pieces[longer][-1]
                part = source.longest(start, int(room[0]), int(room[2]))
                if part > 0:
                    pool.take(longer)
                    pool.put((source, start + part, length - part))
                    found.append((source, start, part))
                    break
            if slot < 0:
                slot = pool.best(room)
            if slot < 0:
                break
            found.append(pool.take(slot))
            room -= pool.sizes[slot]
        return found

    def _finished(self, pieces: list[Piece]) -> Iterator[list[Piece]]:
        total = sum(length for _, _, length in pieces)
        if not self.cut or total == self.limits.tokens:
            yield pieces
            return
        rest = pieces[::-1]
        for bit in range(total.bit_length() - 1, -1, -1):
            need, part = total & 1 << bit, []
            while need:
                source, start, length = rest.pop()
                take = min(need, length)
                part.append((source, start, take))
                need -= take
                if take < length:
                    rest.append((source, start + take, length - take))
            if part:
                yield part


def _rows(sequences: Iterator[list[Piece]], first: int) -> Iterator[tuple]:
    for number, pieces in enumerate(sequences, first):
        at = 0
        for source, start, length in pieces:
            yield (source.name, start, length, source.ids[start:start + length].astype("<u4")
                   .tobytes(), len(source.ids), number, at, source.loss_of(start, length))
            at += length


def _batches(rows: Iterator[tuple], size: int = 2000) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, types, names)
            held = []
    if held:
        yield _batch(held, types, names)


def _batch(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _packed(sources: Iterator[Source], limits: Limits, cut: bool) -> Iterator[pa.RecordBatch]:
    """Sequence numbers begin with the partition's, so tasks share none, and a task that runs
    again gives the numbers it gave before."""
    packer = Packer(limits, cut)

    def sequences() -> Iterator[list[Piece]]:
        for source in sources:
            yield from packer.add(source)
        yield from packer.close()

    yield from _batches(_rows(sequences(), TaskContext.get().partitionId() << 33))


def pack_documents(docs: DataFrame, vocabulary: str, end: int | None = 0, id: str = "doc_id",
                   text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Pieces of documents, packed: one row per piece, with the sequence it lies in, its offset
    there, its ids (little-endian unsigned 32-bit) and how many of them bear loss.

    A document is its ids followed by `end`; null text is empty; documents without ids (`end`
    None) have no piece. Every id lies in one piece. Rows with the same id, or a null id, are
    documents of their own. Other columns are not looked at; an empty table gives no row.

    Each task packs the rows of its own partition, so nothing is shuffled, and a source that
    holds a third of all rows is spread as the files are. A task holds a pool of at most 4096
    pieces and the document at hand."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(vocabulary)
        last = end_bytes(known, end)

        def sources() -> Iterator[Source]:
            for batch in batches:
                for at in range(0, batch.num_rows, TEXTS):
                    names, texts = batch.slice(at, TEXTS).columns
                    for name, ids in zip(names.to_pylist(),
                                         known.arrays(texts, last).to_pylist(), strict=True):
                        yield Source(name, np.frombuffer(ids, known.dtype))

        return _packed(sources(), limits, True)

    rows = in_batches(docs).select(docs[id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return rows.mapInArrow(of, COLUMNS)


def pack_examples(examples: DataFrame, id: str = "id", ids: str = "ids", mask: str = "mask",
                  limits: Limits = Limits()) -> DataFrame:
    """Instruction data, packed whole: ids is an array of token ids, mask one of as many
    booleans that tell which bear loss (null: all but the first). Examples are not cut: one that
    is over a limit gets a sequence of its own. Null or empty ids have no row."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sources() -> Iterator[Source]:
            for batch in batches:
                for name, tokens, bears in zip(*(batch.column(k).to_pylist() for k in range(3)),
                                               strict=True):
                    loss = None if bears is None else np.concatenate(
                        [[0], np.cumsum(np.array(bears, bool))])
                    yield Source(name, np.array(tokens or [], np.int64), loss)

        return _packed(sources(), limits, False)

    return in_batches(examples).select(examples[id].cast("long").alias("id"), examples[ids].alias("ids"),
                           examples[mask].alias("mask")).mapInArrow(of, COLUMNS)
