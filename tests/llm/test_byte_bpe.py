"""Ids by rank file and pattern against the library itself, and bytes back."""

import base64
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import byte_bpe, queries

from helpers import SF, awkward, documents, rows_of

RANKS, PATTERN = queries.vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
ODD = "ab zs'tré12!.,-_ \n\t\r\x0b\x1c\x85\xa0 語学、。ｱ🙂\0\xad"


@pytest.fixture(scope="module")
def plain():
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


@settings(max_examples=500, deadline=None)
@given(text=st.text(alphabet=ODD, max_size=60), long=st.integers(2, 9))
def test_stretches_encode_as_the_whole(plain, text, long):
    parts = list(byte_bpe.stretches(text, long))
    assert "".join(p for p, _ in parts) == text
    assert sum((plain.encode_ordinary(p) for p, _ in parts), []) == plain.encode_ordinary(text)


@pytest.mark.parametrize("tail", ["", "a", " a", "\n", "!"])
@pytest.mark.parametrize("space", [" ", "\n", "\t \n", "　"])
def test_long_white_space(plain, space, tail):
    known = byte_bpe.codec(RANKS, PATTERN)
    for n in (byte_bpe.RUN - 1, byte_bpe.RUN, byte_bpe.RUN + 1, 5 * byte_bpe.RUN):
        text = "word" + (space * n)[:n] + tail
        assert known.encode(text).tolist() == plain.encode_ordinary(text)
    # The library itself runs out of stack here.
    text = "a" + space * 1_200_000 + tail
    assert known.decode(known.encode(text).tolist()) == text.encode()


def test_texts_of_any_kind(plain, spark):
    rng = random.Random(4)
    rows = awkward(3) + [(500 + k, t) for k, t in enumerate(
        ["x" * 300_000, "語学。" * 70_000, "ab1!" * 80_000, "don't " * 40_000, " " * 5000,
         "".join(rng.choice(ODD) for _ in range(200_000)), "<|endoftext|>"])]
    found = byte_bpe.encode(documents(spark, rows).repartition(3), RANKS, PATTERN)
    assert found.columns == ["doc_id", "n_tokens", "ids"]
    expected = [(i, plain.encode_ordinary(t or "")) for i, t in rows]
    assert rows_of(found) == sorted(((i, len(x), x) for i, x in expected), key=repr)
    back = byte_bpe.decode(found, RANKS, PATTERN)
    assert back.columns == ["doc_id", "n_tokens", "decoded"]
    assert rows_of(back) == sorted(((i, len(x), bytearray((t or "").encode()))
                                    for (i, t), (_, x) in zip(rows, expected)), key=repr)


def test_decoding_bytes_nulls_and_clashing_names(spark, plain):
    euro = plain.encode_ordinary("語")
    rows = [(1, euro[:1], "x"), (2, [], "y"), (3, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>, decoded string")
    found = byte_bpe.decode(df, RANKS, PATTERN)
    assert rows_of(found) == [(1, bytearray(plain.decode_bytes(euro[:1]))), (2, bytearray()),
                              (3, None)]
    assert byte_bpe.decode(df.limit(0), RANKS, PATTERN).collect() == []
    assert byte_bpe.encode(documents(spark, []), RANKS, PATTERN).collect() == []
    with pytest.raises(Exception, match="KeyError"):
        byte_bpe.decode(spark.createDataFrame([([999_999],)], "ids array<int>"), RANKS,
                        PATTERN).collect()


def test_the_query_by_the_library(spark, plain):
    import hashlib

    found = {r["doc_id"]: r for r in queries.op12_byte_bpe(spark, SF).collect()}
    docs = queries.table(spark, SF, "documents").collect()
    assert len(found) == len(docs)
    for row in docs:
        text, own = row["text"] or "", found[row["doc_id"]]
        ids = plain.encode_ordinary(text)
        assert own["n_tokens"] == len(ids)
        assert own["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert own["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
