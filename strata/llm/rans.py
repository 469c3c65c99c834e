"""Static range asymmetric numeral system over token ids, many lanes at a time in numpy.

A block holds up to BLOCK ids, dealt in turn to `lanes` coders that write to one stream of
32-bit words. All blocks share one table of frequencies that add up to 2**bits. Every `every`
steps the states of all lanes are kept with the place in the stream: a decoder can start at any
of these checkpoints, and decodes all of them side by side."""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

BITS, LANES, EVERY = 18, 1024, 128
BLOCK = LANES * EVERY * 2
SIDE = 16  # segments decoded at a time
LOW, WORD = np.uint64(1 << 31), np.uint64(32)
MASK = np.uint64((1 << 32) - 1)
HEAD = struct.Struct("<QIIIIQI")  # ids, lanes, steps, every, checkpoints, words, crc of the ids


class Table:
    """Frequencies of the ids 0..n-1, scaled to 2**bits; an id that occurs gets at least 1."""

    def __init__(self, freq: np.ndarray, bits: int = BITS) -> None:
        self.bits, self.freq = bits, freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))
        # By slot, side by side for one look: the id, its frequency, the slot's place in its range.
        self.slots = np.zeros((len(self.symbol), 4), np.uint32)
        self.slots[:, 0], self.slots[:, 1] = self.symbol, self.freq[self.symbol]
        self.slots[:, 2] = np.arange(len(self.symbol), dtype=np.uint64) - self.start[self.symbol]

    @classmethod
    def of(cls, counts: np.ndarray, bits: int = BITS) -> Table:
        counts, total = counts.astype(np.float64), 1 << bits
        present = counts > 0
        if present.sum() > total:
            raise ValueError(f"{present.sum()} ids need more than {bits} bits")
        if not present.any():
            return cls(np.zeros(len(counts), np.int64), bits)
        freq = np.where(present, np.maximum(1, counts * (total / counts.sum())), 0).astype(np.int64)
        order = np.argsort(-freq, kind="stable")
        while (over := int(freq.sum()) - total) > 0:
            share = np.minimum(freq[order] - 1, -(-over // max(1, int((freq > 1).sum()))))
            share = np.maximum(share, 0)
            share[np.cumsum(share) - share >= over] = 0
            freq[order] -= share
        freq[order[0]] += total - int(freq.sum())
        return cls(freq, bits)


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").data)


def _encode_like(ids: np.ndarray, table: Table, every: int) -> list[tuple]:
    """Blocks of one shape, ids[block, step, lane]: states and places at the checkpoints, words."""
    blocks, steps, lanes = ids.shape
    bits, room = np.uint64(table.bits), np.uint64(63 - table.bits)
    x = np.full((blocks, lanes), LOW, np.uint64)
    words = np.empty((blocks, steps * lanes), np.uint32)
    end = np.full(blocks, steps * lanes, np.int64)
    marks = -(-steps // every)
    states, places = np.empty((marks, blocks, lanes), np.uint64), np.empty((marks, blocks), np.int64)
    row = np.arange(blocks) * (steps * lanes)
    flat = words.reshape(-1)
    for t in range(steps - 1, -1, -1):
        s = ids[:, t, :]
        f = table.freq[s]
        over = np.flatnonzero(x >= (f << room))
        each = np.bincount(over // lanes, minlength=blocks)
        end -= each
        states_ = x.reshape(-1)
        full = states_[over]
        flat[np.repeat(row + end - (np.cumsum(each) - each), each) + np.arange(len(over))] = full
        states_[over] = full >> WORD
        q = x // f
        x = (q << bits) + (x - q * f) + table.start[s]
        if t % every == 0:
            states[t // every], places[t // every] = x, end
    return [(states[:, b], places[:, b] - end[b], words[b, end[b]:]) for b in range(blocks)]


def encode(ids: np.ndarray, table: Table, lanes: int = LANES, every: int = EVERY,
           block: int = BLOCK) -> list[bytes]:
    """The ids as blocks. The last one is filled up to whole steps with the commonest id."""
    out, fill = [], int(np.argmax(table.freq)) if len(table.freq) else 0
    whole = len(ids) // block * block
    for part, size in ((ids[:whole], block), (ids[whole:], len(ids) - whole)):
        if not len(part):
            continue
        steps = -(-size // lanes)
        padded = np.concatenate([part, np.full(-len(part) % (steps * lanes), fill, part.dtype)])
        shaped = padded.reshape(-1, steps, lanes)
        for n, (states, places, words) in enumerate(_encode_like(shaped, table, every)):
            real = part[n * size:(n + 1) * size]
            out.append(b"".join([
                HEAD.pack(len(real), lanes, steps, every, len(places), len(words), _crc(real)),
                states.astype("<u8").tobytes(), places.astype("<u8").tobytes(),
                words.astype("<u4").tobytes()]))
    return out


@dataclass
class Segment:
    """What lies between two checkpoints of a block."""

    states: np.ndarray
    words: np.ndarray
    steps: int
    real: int


def segments(block: memoryview | bytes) -> list[Segment]:
    n, lanes, steps, every, marks, size, _ = HEAD.unpack_from(block)
    at = HEAD.size
    states = np.frombuffer(block, "<u8", marks * lanes, at).reshape(marks, lanes)
    places = np.frombuffer(block, "<u8", marks, at + marks * lanes * 8).astype(np.int64)
    words = np.frombuffer(block, "<u4", size, at + marks * (lanes + 1) * 8)
    bounds = [*places[1:], size]
    return [Segment(states[k], words[places[k]:bounds[k]], min(every, steps - k * every),
                    min(n - k * every * lanes, every * lanes)) for k in range(marks)]


def decode_segments(parts: list[Segment], table: Table) -> list[np.ndarray]:
    """The ids of each segment; all are decoded side by side."""
    if not parts:
        return []
    if len(parts) > SIDE:  # what is at hand fits a core's cache
        return [x for k in range(0, len(parts), SIDE)
                for x in decode_segments(parts[k:k + SIDE], table)]
    order = sorted(range(len(parts)), key=lambda k: -parts[k].steps)
    ranked = [parts[k] for k in order]
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    x = np.stack([p.states for p in ranked]).astype(np.uint64)
    sizes = np.array([len(p.words) for p in ranked])
    words = np.concatenate([p.words for p in ranked] + [np.zeros(1, np.uint32)]).astype(np.uint64)
    place = np.cumsum(sizes) - sizes
    steps = np.array([p.steps for p in ranked])
    out = np.zeros((len(parts), int(steps[0]), x.shape[1]), np.uint32)
    for t in range(int(steps[0])):
        live = int(np.searchsorted(-steps, -t, "left"))  # steps > t
        now = x[:live]
        s = table.slots.take(now & mask, axis=0)
        now >>= bits
        now *= s[..., 1]
        now += s[..., 2]
        out[:live, t] = s[..., 0]
        short = np.flatnonzero(now < LOW)
        each = np.bincount(short // now.shape[1], minlength=live)
        at = np.repeat(place[:live] - (np.cumsum(each) - each), each) + np.arange(len(short))
        flat = now.reshape(-1)
        flat[short] = flat[short] << WORD | words[at]
        place[:live] += each
    found: list = [None] * len(parts)
    for rank_, k in enumerate(order):
        found[k] = out[rank_, :parts[k].steps].reshape(-1)[:parts[k].real]
    return found


def decode(blocks: list, table: Table) -> np.ndarray:
    """The ids of all blocks in a row; raises ValueError where a block's checksum differs."""
    split = [segments(b) for b in blocks]
    flat = decode_segments([s for parts in split for s in parts], table)
    at, out = 0, []
    for block, parts in zip(blocks, split, strict=True):
        ids = np.concatenate(flat[at:at + len(parts)])
        at += len(parts)
        if _crc(ids) != HEAD.unpack_from(block)[6]:
            raise ValueError("a block of ids does not match its checksum")
        out.append(ids)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def decode_range(block: memoryview | bytes, table: Table, first: int, count: int) -> np.ndarray:
    """ids first..first+count of a block, from the checkpoints around them alone."""
    _, lanes, _, every, *_ = HEAD.unpack_from(block)
    size = lanes * every
    low, high = first // size, -(-(first + count) // size)
    ids = np.concatenate(decode_segments(segments(block)[low:high], table))
    return ids[first - low * size:][:count]
