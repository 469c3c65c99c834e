"""Subword pieces: sampled segmentations of texts, and their exact inverse.

The pieces of a text are the paths through a lattice: an edge for each vocabulary piece that
matches at a place, weighted with exp(alpha * score). Forward filtering adds up the weights of
all paths to each place, backward sampling draws a path in proportion to its weight. Numbers
come from a hash of the row's key and the place, so a row gives the same path wherever and how
often it is encoded.

Nothing is normalised: a space is the vocabulary's word mark, and a character that the
vocabulary lacks (white space but the space, the mark itself) is its bytes. So decoding gives
the text back to the last character."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import in_batches

MARK = "▁"
PLAIN_MARK = "\ud800"  # stands for the mark's own character in a text; no text holds it
ALPHA = 0.001
DRAW = 24  # bits of a draw: chances are whole numbers, so they do not depend on the place
WORDS, TEXTS = 180_000, 250
EDGES = 8_000_000  # of lattices kept; long stretches reach it before WORDS
STRETCH = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of each number."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + 1


def _room(x: np.ndarray, size: int) -> np.ndarray:
    """The array, with room for `size` values and some more where it had none."""
    if size <= len(x):
        return x
    return np.concatenate([x, np.zeros(max(size, len(x) * 3 // 2) - len(x), x.dtype)])


class Lattices:
    """The lattices of words met so far, in flat arrays: a node stands for a place in a word,
    its edges, by the cumulated chance to be drawn, for the pieces that end there."""

    def __init__(self, model: str, alpha: float) -> None:
        from sentencepiece import SentencePieceProcessor

        found = SentencePieceProcessor(model_file=model)
        names = [found.id_to_piece(k) for k in range(found.get_piece_size())]
        self.byte = {int(n[1:-1], 16): k for k, n in enumerate(names) if found.is_byte(k)}
        if len(self.byte) < 256:
            raise ValueError("the vocabulary has no pieces for single bytes")
        plain = [k for k, n in enumerate(names) if n and not (
            found.is_control(k) or found.is_unknown(k) or found.is_unused(k) or found.is_byte(k))]
        self.pieces = {names[k]: k for k in plain}
        scores = np.array([found.get_score(k) for k in range(len(names))])
        self.logs = alpha * scores
        # Bytes cost more than any piece, so they are drawn where nothing else is left.
        self.byte_log = float(self.logs.min()) - 10.0
        self.longest = max(map(len, self.pieces))
        self._grow(plain, names)
        self.bytes_of = [n.replace(MARK, " ").encode() for n in names]
        for value, k in self.byte.items():
            self.bytes_of[k] = bytes([value])
        self.clear()

    def _grow(self, plain: list[int], names: list[str]) -> None:
        """The vocabulary as a tree of characters: a table from (node, character) to the node
        below, with open addresses, and by node the piece that ends there or -1."""
        below: dict[int, int] = {}
        ends = [-1]
        for k in plain:
            node = 0
            for code in _codes(names[k]).tolist():
                key = node << 21 | code
                if key not in below:
                    below[key] = len(ends)
                    ends.append(-1)
                node = below[key]
            ends[node] = k
        bits = max(4, (4 * len(below)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.below = np.full(1 << bits, -1, np.int32)
        slots = self._slots(np.array(list(below), np.int64)).tolist()
        for slot, (key, node) in zip(slots, below.items(), strict=True):
            while self.keys[slot] >= 0:
                slot = slot + 1 & len(self.keys) - 1
            self.keys[slot], self.below[slot] = key, node
        self.ends = np.array(ends, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * SPREAD >> self.shift).astype(np.int64)

    def _down(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The node below each node by its character, -1 where no piece goes on so."""
        keys = nodes.astype(np.int64) << 21 | codes
        slots = self._slots(keys)
        met = self.keys[slots]
        lost = np.flatnonzero((met != keys) & (met >= 0))
        while len(lost):
            slots[lost] = slots[lost] + 1 & len(self.keys) - 1
            met = self.keys[slots[lost]]
            lost = lost[(met != keys[lost]) & (met >= 0)]
        return self.below[slots]

    def clear(self) -> None:
        self.words: dict[str, int] = {}
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        # By node its first edge; by edge the cumulated chance among its node's, how many nodes
        # it goes back, and the piece (-1 for a character's bytes).
        self.first = np.zeros(1 << 20, np.int64)
        self.total = np.zeros(1 << 20, np.int32)
        self.back, self.piece = np.zeros(1 << 20, np.int16), np.zeros(1 << 20, np.int32)
        self.nodes = self.edges = 0

    def _matches(self, codes: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, ...]:
        """(end, length, piece) of every piece in the words; `room` tells how many characters
        a word has from each place on."""
        codes, found = codes.astype(np.int64), []
        live, nodes = np.arange(len(codes)), np.zeros(len(codes), np.int32)
        for k in range(1, self.longest + 1):
            nodes = self._down(nodes, codes[live + k - 1])
            on = np.flatnonzero(nodes >= 0)
            live, nodes = live[on], nodes[on]
            ended = self.ends[nodes]
            same = np.flatnonzero(ended >= 0)
            found.append((live[same] + k, np.full(len(same), k, np.int32), ended[same]))
            on = np.flatnonzero(room[live] > k)
            live, nodes = live[on], nodes[on]
        return tuple(map(np.concatenate, zip(*found, strict=True)))

    def learn(self, new: list[str]) -> None:
        """Forward filtering of many words at once, place by place."""
        sizes = np.array([len(w) for w in new], np.int64)
        codes = _codes("".join(new))
        word = np.repeat(np.arange(len(new)), sizes)
        place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        end, back, piece = self._matches(codes, sizes[word] - place)
        single = np.zeros(len(codes), bool)
        single[end[back == 1] - 1] = True
        bare = np.flatnonzero(~single)
        end = np.concatenate([bare + 1, end])
        back = np.concatenate([np.ones(len(bare), np.int32), back])
        piece = np.concatenate([np.full(len(bare), -1, np.int32), piece])
        # Characters to nodes: a word of n characters has n + 1 of them. Edges stand by node and
        # length; they come by length, so a stable sort will do.
        order = np.argsort(end, kind="stable")
        end, back, piece = end[order], back[order], piece[order]
        node = end + word[end - 1]
        counts = np.bincount(node, minlength=len(codes) + len(new))
        tall = int(sizes.max())
        level = (place + 1).astype(np.uint16 if tall < 1 << 16 else np.int64)[end - 1]
        del end
        order = np.argsort(level, kind="stable")
        cuts = np.concatenate([[0], np.cumsum(np.bincount(level, minlength=tall + 1)[1:])])
        node_of, log = node[order], piece[order]
        before = node_of - back[order]
        log = np.where(log < 0, self.byte_log, self.logs[log])
        alpha, unit = np.zeros(len(codes) + len(new)), 1 << DRAW
        steps = np.empty(len(node), np.int64)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            x, here = alpha[before[a:b]] + log[a:b], node_of[a:b]
            firsts = np.flatnonzero(np.diff(here, prepend=-1))
            many = np.diff(firsts, append=b - a)
            top = np.maximum.reduceat(x, firsts)
            shifted = np.exp(x - np.repeat(top, many))
            total = np.add.reduceat(shifted, firsts)
            alpha[here[firsts]] = top + np.log(total)
            # Rounded before they are added up, so they do not depend on the words around.
            own = np.rint(shifted / np.repeat(total, many) * unit).astype(np.int64)
            run = np.cumsum(own)
            steps[order[a:b]] = run - np.repeat(run[firsts] - own[firsts], many)
        steps[np.flatnonzero(np.diff(node, append=-1))] = unit
        first, last = self.edges, self.edges + len(node)
        nodes = self.nodes + len(counts)
        self.first = _room(self.first, nodes)
        self.total, self.back, self.piece = (
            _room(x, last) for x in (self.total, self.back, self.piece))
        self.first[self.nodes:nodes] = first + np.cumsum(counts) - counts
        self.total[first:last] = np.minimum(steps, unit)
        self.back[first:last], self.piece[first:last] = back, piece
        self.edges = last
        starts = self.nodes + np.cumsum(sizes + 1) - (sizes + 1)
        self.start, self.length = (np.concatenate(x) for x in (
            (self.start, starts), (self.length, sizes)))
        self.words.update(zip(new, range(len(self.words), len(self.words) + len(new)), strict=True))
        self.nodes = nodes

    def sample(self, ids: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, ...]:
        """One path per word: (which word, the place that a piece begins at, the piece), by
        words and places. Edges that end at a node stand together, and a draw passes those whose
        cumulated chance it reaches; the last one's is above every draw."""
        starts, at = self.start[ids], self.start[ids] + self.length[ids]
        live = np.flatnonzero(at > starts)
        steps = []
        while len(live):
            here = at[live]
            draw = _mixed(seeds[live] ^ (here - starts[live]).astype(np.uint64))
            draw = (draw >> np.uint64(64 - DRAW)).astype(np.int32)
            edge = self.first[here]
            on = np.flatnonzero(self.total[edge] <= draw)
            while len(on):
                edge[on] += 1
                on = on[self.total[edge[on]] <= draw[on]]
            to = here - self.back[edge]
            steps.append((live, to - starts[live], self.piece[edge]))
            at[live] = to
            live = live[to > starts[live]]
        counts = np.zeros(len(ids), np.int64)
        for owners, _, _ in steps:
            counts[owners] += 1
        left = np.cumsum(counts)
        word = np.repeat(np.arange(len(ids)), counts)
        place, piece = np.zeros(len(word), np.int64), np.zeros(len(word), np.int32)
        for owners, begins, drawn in steps:
            left[owners] -= 1
            place[left[owners]], piece[left[owners]] = begins, drawn
        return word, place, piece


def words(text: str) -> list[str]:
    """The stretches that no piece crosses: a run of marks (spaces) with what follows up to the
    next run, of any length."""
    return STRETCH.findall(text.replace(MARK, PLAIN_MARK).replace(" ", MARK))


@functools.lru_cache(maxsize=2)
def lattices(model: str, alpha: float) -> Lattices:
    """One per Python worker, so what it knows outlives a task."""
    return Lattices(model, alpha)


def segment(known: Lattices, texts: list[str], seeds: np.ndarray) -> list[np.ndarray]:
    """The sampled pieces of each text."""
    if len(known.words) > WORDS or known.edges > EDGES:
        known.clear()
    split = [words(t) if t else [] for t in texts]
    flat = [w for x in split for w in x]
    if not flat:
        return [np.zeros(0, np.uint32) for _ in texts]
    if new := list(dict.fromkeys(flat).keys() - known.words.keys()):
        known.learn(new)
    ids = np.array(list(map(known.words.__getitem__, flat)), np.int64)
    sizes = np.array([len(x) for x in split], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    turn = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    word, place, piece = known.sample(
        ids, _mixed(seeds[owner] ^ _mixed(turn.astype(np.uint64))))
    ends = np.searchsorted(owner[word], np.arange(1, len(texts) + 1))
    bare = np.flatnonzero(piece < 0)
    if len(bare):
        spelled = [(PLAIN_MARK_BYTES if c == PLAIN_MARK else c.encode()) for c in
                   (flat[word[k]][place[k]] for k in bare.tolist())]
        widths = np.ones(len(piece), np.int64)
        widths[bare] = [len(c) for c in spelled]
        ends = np.concatenate([[0], np.cumsum(widths)])[ends]
        at = (np.cumsum(widths) - widths)[bare]
        piece = np.repeat(piece, widths)
        for k, c in zip(at.tolist(), spelled, strict=True):
            piece[k:k + len(c)] = [known.byte[b] for b in c]
    return np.split(piece.astype("<u4"), ends[:-1])


PLAIN_MARK_BYTES = MARK.encode()


def sample_pieces(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text",
                  alpha: float = ALPHA, seed: int = 0) -> DataFrame:
    """One row (doc_id, text, pieces) per row of docs; pieces are ids, little-endian unsigned
    32-bit. Rows are sampled by their id: the same id, text and seed give the same pieces, in
    any order and partition, so rows that repeat give the same again; null ids share a key.

    Null and empty texts have no piece. Texts of any length are taken whole, in some working
    memory per character. Other columns are not looked at; an empty table gives no row. Nothing
    is shuffled."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lattices(model, alpha)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                keys = part.column(2).to_numpy().view(np.uint64)
                found = segment(known, [t or "" for t in part.column(1).to_pylist()], keys)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1),
                     pa.array([x.tobytes() for x in found], pa.binary())],
                    ["doc_id", "text", "pieces"])

    return in_batches(docs).select(
        docs[id].cast("long").alias("doc_id"), docs[text].alias("text"),
        F.xxhash64(docs[id].cast("long"), F.lit(seed)).alias("key")).mapInArrow(
        of, "doc_id long, text string, pieces binary")


def decode_pieces(rows: DataFrame, model: str) -> DataFrame:
    """The rows with a column decoded: the text that their pieces spell."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = lattices(model, ALPHA).bytes_of
        for batch in batches:
            at = batch.schema.get_field_index("pieces")
            texts = [b"".join(map(spelled.__getitem__, np.frombuffer(p.as_buffer(), "<u4").tolist()))
                     .decode() for p in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return rows.mapInArrow(of, rows.schema.simpleString()[7:-1].replace(":", " ")
                           + ", decoded string")
