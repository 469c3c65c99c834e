"""Byte-level BPE by the tiktoken library: token ids of whole texts, and their bytes back."""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import in_batches
from strata.llm.tokens import SPACE

LONG = 1 << 16  # characters that the library is given at a time
RUN = 1 << 10  # white space that its pattern is given in a row
TEXTS = 200
# Places that no match of the pattern spans: before white space, and between a letter or digit
# and a mark. Only characters whose kind is the same in every version of Unicode are named.
SAFE = re.compile(f"(?<=[^{SPACE}])(?=[{SPACE}])"
                  "|(?<=[0-9A-Za-z一-龥ぁ-んァ-ヴ])(?=[!-/:-@\\[-`{-~、。，！？])")
RUNS = re.compile(f"[{SPACE}]{{{RUN},}}")


def stretches(text: str, long: int = LONG) -> Iterator[tuple[str, bool]]:
    """The text in stretches, cut where no match of the pattern can span, and whether a stretch is
    one match as it stands. A long run of white space is one, without its last character if
    something follows; the library's pattern steps back through it and runs out of stack."""
    at = 0
    for run in RUNS.finditer(text) if len(text) >= RUN else ():
        for part in _cut(text, at, run.start(), long):
            yield part, False
        at = run.end() if run.end() == len(text) else run.end() - 1
        yield text[run.start():at], True
    for part in _cut(text, at, len(text), long):
        yield part, False


def _cut(text: str, at: int, end: int, long: int) -> Iterator[str]:
    """text[at:end] in stretches of at most `long` characters, or up to the next safe place."""
    while end - at > long:
        # The lookbehind may see what stands before `at`, so a cut at `at` itself is no cut.
        places = [m.start() for m in SAFE.finditer(text, at + long // 2, at + long)]
        if places:
            to = places[-1]
        else:
            found = SAFE.search(text, at + long)
            to = min(found.start(), end) if found else end
        yield text[at:to]
        at = to
    if at < end:
        yield text[at:end]


class Codec:
    """What the library does with a rank file and a pattern, for texts of any kind and length."""

    def __init__(self, ranks: str, pattern: str) -> None:
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}
        self.own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table,
                                     special_tokens={})
        self.bytes = {rank: token for token, rank in table.items()}

    def encode(self, text: str) -> np.ndarray:
        if len(text) < RUN:
            return np.array(self.own.encode_ordinary(text), np.int32)
        found = [np.array(self.own._encode_single_piece(part.encode()) if single
                          else self.own.encode_ordinary(part), np.int32)
                 for part, single in stretches(text)]
        return np.concatenate(found) if found else np.zeros(0, np.int32)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def codec(ranks: str, pattern: str) -> Codec:
    """One per Python worker."""
    return Codec(ranks, pattern)


def encode(docs: DataFrame, ranks: str, pattern: str, id: str = "doc_id", text: str = "text"
           ) -> DataFrame:
    """One row (doc_id, n_tokens, ids) per row of docs: the ids that the library gives for the
    whole text by the rank file, each match of the pattern by itself, without special tokens.

    Null and empty texts have no ids. Texts of any length are whole: long ones reach the library
    in stretches cut where no match spans, with the same ids. Null ids of rows and repeated rows
    are returned as they are, other columns not looked at; an empty table gives an empty result."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(ranks, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                ids = [known.encode(t or "") for t in part.column(1).to_pylist()]
                sizes = np.array([len(x) for x in ids], np.int64)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(values))],
                    ["doc_id", "n_tokens", "ids"])

    kind = docs.schema[id].dataType.simpleString()
    return in_batches(docs).select(docs[id].alias("doc_id"), docs[text].alias("text")).mapInArrow(
        of, f"doc_id {kind}, n_tokens long, ids array<int>")


def decode(rows: DataFrame, ranks: str, pattern: str, ids: str = "ids", out: str = "decoded"
           ) -> DataFrame:
    """`rows` with the column `out` in place of `ids`: the bytes of their tokens, which need not
    be whole characters. Null ids give null, no ids no bytes; an id that the rank file does not
    have, or a null among ids, is an error. All other columns stay, whatever their names."""
    others = [c for c in rows.columns if c not in (ids, out)]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(ranks, pattern)
        for batch in batches:
            last = batch.num_columns - 1
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                found = [None if x is None else known.decode(x)
                         for x in part.column(last).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:last], pa.array(found, pa.binary())], [*others, out])

    schema = rows.select(*others).schema.add(out, "binary")
    return in_batches(rows).select(*others, ids).mapInArrow(of, schema)
