"""Token ids of texts, by a tokenizer file, inside Spark tasks."""

from __future__ import annotations

import functools
import json
import os
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from strata.llm.common import in_batches

# The characters that the pre-tokenizer's \s stands for (Unicode White_Space).
SPACE = "\t-\r \x85\xa0  -     　"
MARKS = string.punctuation.replace("'", "")
WHITE, LETTER, MARK = 1, 2, 3
KINDS = np.zeros(256, np.uint8)  # of ASCII bytes, where a text may be cut
for _kind, _bytes in ((WHITE, b"\t\n\x0b\x0c\r "), (LETTER, string.ascii_letters.encode()),
                      (MARK, MARKS.encode())):
    KINDS[list(_bytes)] = _kind
# White space of several bytes, by its last two or three.
WIDE = np.array([int.from_bytes(c.encode(), "big") for c in map(chr, range(0x80, 0x3001))
                 if re.match(f"[{SPACE}]", c)])
CACHED, TEXTS = 600_000, 1000
JOINED, LONG = 100, 200  # pieces the model gets at a time; characters of a piece worth keeping


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters for themselves, the others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}


LETTERS = _byte_letters()
NEVER = [0xC0, 0xC1, *range(0xF5, 0x100)]


class Encoder:
    """many(texts) is what the tokenizer gives for whole texts without special tokens, as
    little-endian bytes of `dtype`; strings of special tokens in a text are ordinary text.
    arrays() gives the same for an Arrow array, with `last` behind each text.

    A byte-level pre-tokenizer never joins a non-space character to the white space after it, nor
    a letter to a mark after it that is no apostrophe, so a text may be cut there. Pieces met
    before are looked up, the tokenizer's model is asked for the others. Any other kind of
    tokenizer gets the texts whole."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        described = json.loads(self.tokenizer.to_str())
        pre, model = described["pre_tokenizer"] or {}, described["model"]
        self.by_piece = (described["normalizer"] is None and pre.get("type") == "ByteLevel"
                         and pre.get("use_regex") and not pre.get("add_prefix_space"))
        self.model = self.tokenizer.model
        self.apart: list[str] = []
        if model["type"] == "BPE":  # its own cache is no use to pieces not met yet
            options = {k: v for k, v in model.items() if k not in ("type", "vocab", "merges") and v}
            merges = [tuple(x) for x in model["merges"]]
            self.model = BPE(model["vocab"], merges, cache_capacity=0, **options)
            # Letters of bytes that UTF-8 has not, in the vocabulary but in no merge, keep apart
            # what the model gets in one call.
            merged = {x for pair in merges for x in pair}
            self.apart = [LETTERS[c] for c in NEVER if not options and LETTERS[c] in model["vocab"]
                          and LETTERS[c] not in merged][:2]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _letters(self, piece: str) -> list[str]:
        """The pre-tokens of a piece, in letters that stand for bytes. Of a word, as most pieces
        are, they are plain: the word with its space."""
        before = piece[:1] if piece[:1] in (" ", "\n") else ""
        body = piece[len(before):]
        if body.isalpha() and (body.isascii() or max(body) < "ɐ"):
            if not body.isascii():
                body = body.encode().decode("latin-1").translate(LETTERS)
            return ["Ġ" + body] if before == " " else ["Ċ", body] if before else [body]
        return [part for part, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(piece)]

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """What the model gives for pieces that are new."""
        tokenize = self.model.tokenize
        if len(self.apart) < 2:
            return [np.array([t.id for part in self._letters(piece) for t in tokenize(part)],
                             self.dtype).tobytes() for piece in pieces]
        piece_end, part_end = self.apart
        words = [("Ġ" + x[1:] if x[0] == " " else x) if x.isascii() and x[1:].isalpha()
                 and (x[0] == " " or x[0].isalpha()) else part_end.join(self._letters(x))
                 for x in pieces]
        ids = np.array([t.id for at in range(0, len(words), JOINED)
                        for t in tokenize(piece_end.join(words[at:at + JOINED]) + piece_end)])
        ends = ids == self.model.token_to_id(piece_end)
        real = ~ends & (ids != self.model.token_to_id(part_end))
        flat = ids[real].astype(self.dtype).tobytes()
        bounds = (np.cumsum(real)[ends] * self.dtype.itemsize).tolist()
        return [flat[a:b] for a, b in zip([0, *bounds], bounds)]

    def _known(self, pieces: list[str]) -> list[bytes]:
        """The ids of different pieces, known from now on."""
        found = list(map(self.known.get, pieces))
        missing = [k for k, ids in enumerate(found) if ids is None]
        new = []
        for k in missing:
            found[k] = self.older.get(pieces[k])
            if found[k] is None:
                new.append(k)
        for k, ids in zip(new, self._ids([pieces[k] for k in new]) if new else [], strict=True):
            found[k] = ids
        if len(self.known) + len(missing) > CACHED:
            self.older, self.known = self.known, {}
        self.known.update((pieces[k], found[k]) for k in missing if len(pieces[k]) <= LONG)
        return found

    def arrays(self, texts: pa.Array, last: bytes = b"") -> pa.Array:
        """The ids of each text, null as an empty one, and `last` behind them."""
        if not self.by_piece:
            found = self.tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()],
                                                     add_special_tokens=False)
            return pa.array([np.array(f.ids, self.dtype).tobytes() + last for f in found],
                            pa.large_binary())
        pieces, bounds = _pieces(texts)
        named = pieces.dictionary_encode()
        ids = [*self._known(named.dictionary.to_pylist()), last]
        # `last` is one more piece at the end of each text.
        order = np.insert(named.indices.to_numpy(), bounds[1:], len(ids) - 1)
        flat = pa.array(ids, pa.large_binary()).take(pa.array(order))
        ends = np.frombuffer(flat.buffers()[1], np.int64)[bounds + np.arange(len(bounds))]
        return pa.Array.from_buffers(pa.large_binary(), len(texts), [
            None, pa.py_buffer(np.ascontiguousarray(ends)), flat.buffers()[2]])

    def many(self, texts: list[str | None]) -> list[bytes]:
        return self.arrays(pa.array(texts, pa.string())).to_pylist()


def _pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All texts in pieces, which lie where the texts do, and with which piece each text begins;
    the number of pieces comes last."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1]
    if not len(offsets) or offsets[0] == offsets[-1]:
        return pa.array([], pa.string()), np.zeros(len(texts) + 1, np.int64)
    data = data.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    offsets, content = offsets - offsets[0], np.frombuffer(data, np.uint8)
    kinds = KINDS[content]
    cut = np.zeros(len(content) + 1, bool)
    cut[1:-1] = (((kinds[1:] == WHITE) & (kinds[:-1] != WHITE))
                 | ((kinds[1:] == MARK) & (kinds[:-1] == LETTER)))
    wide = np.flatnonzero(cut[1:-1] & (content[:-1] >= 0x80)) + 1
    if len(wide):
        last = content[np.maximum(wide[:, None] - [3, 2, 1], 0)].astype(np.int64) @ [1 << 16, 1 << 8, 1]
        cut[wide[np.isin(last, WIDE) | np.isin(last & 0xFFFF, WIDE)]] = False
    cut[offsets] = True
    places = np.flatnonzero(cut)
    pieces = pa.Array.from_buffers(pa.string(), len(places) - 1, [
        None, pa.py_buffer(places.astype(np.int32)), data])
    return pieces, np.searchsorted(places, offsets)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker, so what it knows outlives a task."""
    return Encoder(path)


def end_bytes(known: Encoder, end: int | None) -> bytes:
    return b"" if end is None else np.array([end], known.dtype).tobytes()


def encode(docs: DataFrame, vocabulary: str, end: int | None = None, id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """One row (doc_id, n_tokens, ids) per row of docs. ids are little-endian, 16 bits wide if
    the vocabulary allows it and else 32; `end` is appended to each. Null text is empty."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(vocabulary)
        last = end_bytes(known, end)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                ids = known.arrays(part.column(1), last)
                lengths = pc.divide(pc.binary_length(ids), known.dtype.itemsize)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lengths.cast(pa.int64()), ids.cast(pa.binary())],
                    ["doc_id", "n_tokens", "ids"])

    rows = in_batches(docs).select(docs[id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return rows.mapInArrow(of, "doc_id long, n_tokens long, ids binary")
