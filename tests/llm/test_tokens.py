"""Token files, packing and sampled pieces against the tokenizers themselves."""

import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import packing, pieces, queries, rans, token_files, tokens

from helpers import awkward, documents, rows_of

BPE = queries.vocabulary("byte_bpe_50k.json")
ODD = "ab A.,'s!1 \n\t\r\x0b\x1c\x1f\x85\xa0é ü 　​語🙂\0<|endoftext|>"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(BPE)
    found.encode_special_tokens = True
    return found


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=ODD, max_size=30)), max_size=4))
def test_pieces_of_a_text_encode_as_the_whole(tokenizer, texts):
    known = tokens.encoder(BPE)
    found = [np.frombuffer(x, known.dtype).tolist() for x in known.many(texts)]
    assert found == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_a_full_cache_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "CACHED", 20)
    known, rng = tokens.Encoder(BPE), random.Random(1)
    for _ in range(60):
        texts = [" ".join(rng.choice("abcdefg") * rng.randrange(1, 4) + rng.choice(["", ".", ",", "\n"])
                          for _ in range(9)) for _ in range(3)]
        assert [np.frombuffer(x, known.dtype).tolist() for x in known.many(texts)] == [
            tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(known.known) + len(known.older) < 200


class Counted:
    """A tokenizer's model that counts what it is asked."""

    def __init__(self, model):
        self.model, self.calls = model, 0

    def __getattr__(self, name):
        return getattr(self.model, name)

    def tokenize(self, letters):
        self.calls += 1
        return self.model.tokenize(letters)


def test_new_pieces_reach_the_model_many_at_a_time(tokenizer):
    known, rng = tokens.Encoder(BPE), random.Random(2)
    words = ["".join(rng.choices("etaoinshrdlu", k=9)) + end for end in ["", ".", ",", ";", "é", "7"]
             for _ in range(500)]
    known.model = Counted(known.model)
    text = " ".join(words) + "\n" + "\n\n".join(words[:50])
    assert np.frombuffer(known.many([text])[0], known.dtype).tolist() == tokenizer.encode(
        text, add_special_tokens=False).ids
    assert known.model.calls < 40
    known.apart = []  # a vocabulary without such letters
    text = "Another text, of other words."
    assert np.frombuffer(known.many([text])[0], known.dtype).tolist() == tokenizer.encode(
        text, add_special_tokens=False).ids


def test_texts_are_read_where_they_lie(tokenizer):
    texts = ["left out", None, "a b.c", "", "語\u3000 x\u2003\n y\xa0 z", " ", "é\u0085 é it's.",
             "\x1c \x1f", "left out"]
    found = tokens.encoder(BPE).arrays(pa.array(texts).slice(1, 7), b"\2\0")
    assert [np.frombuffer(x, "<u2").tolist() for x in found.to_pylist()] == [
        tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts[1:8]]


def test_other_kinds_of_tokenizer_get_whole_texts():
    from tokenizers import Tokenizer

    path = queries.vocabulary("word_bpe_49k.json")
    known, plain = tokens.Encoder(path), Tokenizer.from_file(path)
    texts = ["Some  words, here.", "", None, "Ünïcode\n\n x"]
    assert not known.by_piece
    assert [np.frombuffer(x, known.dtype).tolist() for x in known.many(texts)] == [
        plain.encode(t or "", add_special_tokens=False).ids for t in texts]


# The codec.

@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 63, 64, 65, 200, 1000])
def test_codec_round_trip_at_all_block_ends(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.05, n), 300).astype(np.uint16)
    table = rans.Table.of(np.bincount(ids, minlength=301), 12)
    blocks = rans.encode(ids, table, lanes=4, every=4, block=64)
    assert (rans.decode(blocks, table) == ids).all()
    for first in range(0, max(0, min(n, 64) - 5), 3):
        assert (rans.decode_range(blocks[0], table, first, 5) == ids[first:first + 5]).all()


@pytest.mark.parametrize("side", [1, 3, 100])
def test_segments_are_decoded_some_at_a_time(monkeypatch, side):
    monkeypatch.setattr(rans, "SIDE", side)
    ids = np.minimum(np.random.default_rng(side).geometric(0.05, 1003), 300).astype(np.uint16)
    table = rans.Table.of(np.bincount(ids, minlength=301), 12)
    blocks = rans.encode(ids, table, lanes=4, every=4, block=64)
    calls, take = [], rans.decode_segments
    monkeypatch.setattr(rans, "decode_segments", lambda parts, table: calls.append(
        len(parts)) or take(parts, table))
    assert (rans.decode(blocks, table) == ids).all()
    assert calls[0] == 64 - 1 and sorted(calls[1:], reverse=True)[:1] in ([], [side])


def test_code_length_is_near_the_entropy():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.zipf(1.3, 1_000_000), 50_000).astype(np.uint16)
    counts = np.bincount(ids, minlength=50_257)
    share = counts[counts > 0] / len(ids)
    entropy = -(share * np.log2(share)).sum() * len(ids) / 8
    table = rans.Table.of(counts)
    assert table.freq.sum() == 1 << rans.BITS and ((table.freq > 0) == (counts > 0)).all()
    assert sum(map(len, rans.encode(ids, table))) < 1.08 * entropy + 20_000


def test_more_symbols_than_slots_are_refused():
    with pytest.raises(ValueError):
        rans.Table.of(np.ones(300), 8)


def test_a_changed_block_is_noticed():
    ids = np.arange(500, dtype=np.uint16) % 50
    table = rans.Table.of(np.bincount(ids, minlength=50), 10)
    block = bytearray(rans.encode(ids, table, lanes=4, every=16, block=512)[0])
    block[-3] ^= 4
    with pytest.raises(ValueError):
        rans.decode([bytes(block)], table)


# Files.

def test_token_files(spark, path, tokenizer, monkeypatch):
    monkeypatch.setattr(rans, "BLOCK", rans.LANES * rans.EVERY)
    rows = awkward(4)
    token_files.write_tokens(documents(spark, rows), BPE, path("t"), end=2, file_ids=20_000)
    found = token_files.read_tokens(spark, path("t")).orderBy("start").collect()
    ids = lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
    want = sorted(((i is not None, i or 0), crc(ids(t)), len(ids(t))) for i, t in rows)
    assert sorted(((r.doc_id is not None, r.doc_id or 0), zlib.crc32(r.ids), r.n_tokens)
                  for r in found) == want
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in found]
    assert keys == sorted(keys)
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
    assert len(token_files.manifest(spark, path("t"))) > 1


def test_token_files_of_an_empty_table(spark, path):
    token_files.write_tokens(documents(spark, []), BPE, path("t"), end=2)
    assert token_files.read_tokens(spark, path("t")).count() == 0
    with pytest.raises(ValueError):
        token_files.write_tokens(documents(spark, []), BPE, path("u"), end=60_000)


def test_a_changed_file_is_noticed(spark, path):
    token_files.write_tokens(documents(spark, [(1, "some words"), (2, "more words")]), BPE,
                             path("t"))
    content = bytearray(spark.read.format("binaryFile").load(path("t") + "/blocks").first().content)
    content[len(content) // 2] ^= 1
    with pytest.raises(ValueError):
        list(token_files.documents(bytes(content), token_files._table(spark, path("t"))))


# Packing.

def held(rows, limits, whole=False):
    """Sequences by id, after checks that hold for every packing."""
    found = collections.defaultdict(list)
    for r in rows:
        found[r.sequence_id].append(r)
    for parts in found.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at and r.length == len(r.ids) // 4 > 0
            at += r.length
        alone = whole and len(parts) == 1
        assert alone or (at <= limits.tokens and len(parts) <= limits.segments
                         and sum(r.loss_tokens for r in parts) <= limits.loss)
    return found


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(64, 3, 64),
                                    packing.Limits(64, 64, 20), packing.Limits(10, 1, 5)])
def test_documents_are_packed_whole(spark, tokenizer, limits):
    rows = [(n, t) for n, (_, t) in enumerate(awkward(2, 90))]
    found = packing.pack_documents(documents(spark, rows), BPE, limits=limits).collect()
    sequences = held(found, limits)
    by_doc = collections.defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
    for n, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        parts = sorted(by_doc[n], key=lambda r: r.start)
        assert [r.start for r in parts] == [0, *np.cumsum([r.length for r in parts])[:-1]]
        assert b"".join(r.ids for r in parts) == np.array(ids, "<u4").tobytes()
        assert {r.doc_tokens for r in parts} == {len(ids)}
    sizes = [sum(r.length for r in s) for s in sequences.values()]
    assert all(n == limits.tokens or n & (n - 1) == 0 for n in sizes)
    if limits == packing.Limits():
        assert sizes.count(1024) >= sum(sizes) // 1024 - spark.sparkContext.defaultParallelism


def test_repeated_and_null_ids_and_no_end(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "c"), (2, ""), (3, None)]
    found = packing.pack_documents(documents(spark, rows), BPE, end=None).collect()
    assert sorted((r.doc_id or 0, r.length) for r in found) == [(0, 1), (1, 2), (1, 2)]
    assert packing.pack_documents(documents(spark, []), BPE).count() == 0


def test_examples_stay_whole_within_three_limits(spark):
    rng = random.Random(5)
    rows = []
    for n in range(600):
        size = rng.choice([3, 20, 90, 200, 400])
        first = rng.randrange(size + 1)
        rows.append((n, list(range(size)), [k >= first for k in range(size)]))
    rows += [(600, list(range(2000)), None), (601, [], []), (602, None, None)]
    df = spark.createDataFrame(rows, "id long, ids array<int>, mask array<boolean>").coalesce(1)
    limits = packing.Limits(1024, 12, 500)
    found = packing.pack_examples(df, limits=limits).collect()
    sequences = held(found, limits, whole=True)
    assert sorted(r.doc_id for r in found) == list(range(601))
    for r in found:
        mask = rows[r.doc_id][2]
        assert r.loss_tokens == (1999 if mask is None else sum(mask)) and r.start == 0
    fits = rows[:600]
    bound = max(sum(len(r[1]) for r in fits) / 1024, len(fits) / 12,
                sum(sum(r[2]) for r in fits) / 500)
    assert len(sequences) - 1 <= 1.15 * bound + 2


def test_packing_is_the_same_again(spark):
    docs = documents(spark, awkward(7, 90)).coalesce(1)
    run = lambda: rows_of(packing.pack_documents(docs, BPE))
    assert run() == run()


# Pieces.

MODEL = queries.vocabulary("piece_bpe_32k.model")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="the ing\n\t▁é語🙂 aA0\0.", max_size=40), min_size=1, max_size=5),
       st.integers(0, 2 ** 60))
def test_sampled_pieces_are_lossless_and_depend_on_the_row_alone(texts, seed):
    known = pieces.lattices(MODEL, pieces.ALPHA)
    keys = (np.arange(len(texts)) + seed).astype(np.uint64)
    found = pieces.segment(known, texts, keys)
    assert [b"".join(known.bytes_of[i] for i in x).decode() for x in found] == texts
    for k, text in enumerate(texts):
        assert (pieces.segment(known, [text], keys[k:k + 1])[0] == found[k]).all()


def test_paths_are_drawn_by_their_weight():
    known = pieces.Lattices(MODEL, 0.001)

    def paths(s):
        if not s:
            yield ()
        for k in range(1, len(s) + 1):
            if s[:k] in known.pieces:
                for rest in paths(s[k:]):
                    yield (known.pieces[s[:k]], *rest)

    weights = {p: np.exp(sum(known.logs[i] for i in p)) for p in paths("▁thing")}
    total = sum(weights.values())
    n = 40_000
    drawn = collections.Counter(
        tuple(x.tolist()) for x in pieces.segment(known, [" thing"] * n, np.arange(n, dtype=np.uint64)))
    assert set(drawn) <= set(weights)
    for p, w in weights.items():
        share = w / total
        assert abs(drawn[p] / n - share) < 5 * np.sqrt(share * (1 - share) / n) + 1e-4


def test_paths_run_through_spaces_and_long_stretches():
    known = pieces.lattices(MODEL, pieces.ALPHA)
    names = {k: n for n, k in known.pieces.items()}
    assert all(pieces.MARK not in n.lstrip(pieces.MARK) for n in known.pieces)
    for text in ["a  b", "    if x:\n        y", "end   ", " " * 40 + "z", "語言処理" * 120,
                 "aGVsbG8" * 90]:
        # Every piece that matches the whole text is an edge of the stretches' lattices.
        whole = text.replace(" ", pieces.MARK)
        want = {(at, at + n) for at in range(len(whole)) for n in range(1, known.longest + 1)
                if whole[at:at + n] in known.pieces and at + n <= len(whole)}
        found, at = set(), 0
        for word in pieces.words(text):
            end, back, _ = known._matches(pieces._codes(word), len(word) - np.arange(len(word)))
            found |= set(zip((at + end - back).tolist(), (at + end).tolist(), strict=True))
            at += len(word)
        assert found == want
    drawn = pieces.segment(known, ["x" + " " * 8 + "y"] * 4000, np.arange(4000, dtype=np.uint64))
    assert any(len(names.get(int(k), "").strip("x")) > 1 for x in drawn for k in x)


def test_clearing_the_lattices_changes_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "WORDS", 5)
    known, fresh = pieces.Lattices(MODEL, 0.001), pieces.Lattices(MODEL, 0.001)
    for n in range(30):
        texts = [f"some word{n} and oth{n}er words", "x" * 500 + " y"]
        keys = np.array([n, n + 1], np.uint64)
        one, two = pieces.segment(known, texts, keys), pieces.segment(fresh, texts, keys)
        fresh.clear()
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(one, two, strict=True))


def test_piece_rows(spark):
    rows = awkward(9)
    docs = documents(spark, rows)
    found = pieces.decode_pieces(pieces.sample_pieces(docs, MODEL), MODEL)
    again = pieces.sample_pieces(docs.repartition(7), MODEL)
    assert rows_of(found.drop("decoded")) == rows_of(again)
    assert rows_of(found.select("doc_id", "decoded")) == sorted(
        ((i, t or "") for i, t in rows), key=repr)
    other = pieces.sample_pieces(docs, MODEL, seed=1)
    assert rows_of(other) != rows_of(again)
    assert pieces.sample_pieces(documents(spark, []), MODEL).count() == 0
    assert found.where(F.col("text").isNull() & (F.octet_length("pieces") > 0)).count() == 0
