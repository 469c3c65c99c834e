"""Vector codes and hard negatives against plain computations."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import hard_negatives, vector_codes
from strata.llm.hard_negatives import PRIMES, Residues, primes_for

from helpers import rows_of

SCHEMA = "vec_id long, embedding array<double>, label int"
NAN, INF = float("nan"), float("inf")


def vectors(spark, rows, clash=True):
    df = spark.createDataFrame(rows, SCHEMA)
    if clash:  # columns named as the operators name their own
        for name in ("ints", "peak", "code", "error", "score", "rank", "window", "id", "vector"):
            df = df.withColumn(name, F.lit(name))
    return df


def awkward_vectors(seed=0, n=60, width=16):
    """Ties, repeated rows and vectors, a large group of one vector, nulls everywhere, vectors of
    other lengths and components that are not finite."""
    rng = random.Random(seed)
    draw = lambda: [rng.choice([-1.0, -0.3, 0.0, 0.01, 0.25, 0.7, 1.5]) for _ in range(width)]
    same = draw()
    rows = [(k, draw() if k % 3 else same, rng.choice([None, 0, 1, 2])) for k in range(n)]
    rows += rows[:5] + [(5, draw(), 1), (None, draw(), 1), (None, draw(), None)]
    rows += [(200, None, 1), (201, [], 1), (202, [1.0, None] + same[2:], 1),
             (203, [NAN] + same[1:], 2), (204, [INF] + same[1:], 2), (205, same[:5], 0)]
    rng.shuffle(rows)
    return rows


def whole(rows):
    return [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x)
                                                        for x in r[1])]


def plain_codes(rows, parts, entries, rounds, scale=4096):
    rows = whole(rows)
    width = -(-max([len(r[1]) for r in rows], default=0) // parts)
    ints = [[int(np.floor(scale * x)) for x in r[1]] + [0] * (parts * width - len(r[1]))
            for r in rows]
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in ints]
    first = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, np.array(
        ints[k], "<i4")[:len(rows[k][1])].tobytes()))[:entries]
    books = [[list(cut[k][p]) for k in first] for p in range(parts)]

    def chosen(p, v):
        gaps = [sum((a - b) ** 2 for a, b in zip(v, e)) for e in books[p]]
        return min(range(len(gaps)), key=lambda e: (gaps[e], e)), min(gaps)

    for _ in range(rounds):
        moved = [[list(e) for e in b] for b in books]
        for p in range(parts):
            taken = [chosen(p, v[p])[0] for v in cut]
            for e in range(len(books[p])):
                own = [v[p] for v, t in zip(cut, taken) if t == e]
                if own:
                    moved[p][e] = [sum(x) // len(own) for x in zip(*own)]
        books = moved
    found = [[chosen(p, v[p]) for p in range(parts)] for v in cut]
    errors = [sum(g for _, g in f) for f in found]
    by_label = {}
    for r, e in zip(rows, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{c:02x}" for c, _ in f), e, by_label[r[2]], sha)
                   for r, f, e in zip(rows, found, errors)), key=repr)


@pytest.mark.parametrize("parts, entries, rounds", [(8, 16, 6), (4, 3, 2), (3, 70, 1), (1, 100, 2)])
def test_codes_as_by_plain_search(spark, parts, entries, rounds):
    rows = awkward_vectors(parts)
    df = vectors(spark, rows).repartition(5)
    assert rows_of(vector_codes.vector_codes(df, parts=parts, entries=entries, rounds=rounds)
                   ) == plain_codes(rows, parts, entries, rounds)


def test_codes_of_few_or_no_rows(spark):
    for rows in ([], [(1, None, 1)], [(1, [NAN], 1)]):
        assert rows_of(vector_codes.vector_codes(vectors(spark, rows))) == []
    rows = [(1, [], None), (2, [0.5], None)]
    assert rows_of(vector_codes.vector_codes(vectors(spark, rows))) == plain_codes(rows, 8, 16, 6)
    with pytest.raises(ValueError):
        vector_codes.vector_codes(vectors(spark, rows), entries=257)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2 ** 32), st.integers(1, 130), st.integers(1, 9), st.integers(1, 5000))
def test_masks_find_the_nearest_entry(seed, entries, width, spread):
    rng = np.random.default_rng(seed)
    book = rng.integers(-spread, spread + 1, (entries, width))
    points = np.concatenate([rng.integers(-2 * spread, 2 * spread + 1, (50, width)), book[:20]])
    gaps = ((points[:, None] - book[None]) ** 2).sum(2)
    code, gap = vector_codes.nearest(points, book)
    assert code.tolist() == gaps.argmin(1).tolist()  # the first of ties
    assert gap.tolist() == gaps.min(1).tolist()


def test_masks_leave_most_entries_unmeasured():
    """The radius of the guess keeps few of the entries of a spread-out codebook."""
    rng = np.random.default_rng(1)
    book = rng.integers(-4000, 4000, (64, 8))
    points = book[rng.integers(0, 64, 500)] + rng.integers(-200, 200, (500, 8))
    part = vector_codes.Slices(book, 0)
    masks = part.within(points, vector_codes._root(part.guess(points)[1]))
    assert np.bitwise_count(masks).mean() < 8


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2 ** 32), st.integers(1, 40), st.sampled_from([3, 250, 70_000, 2_000_000]))
def test_scores_modulo_primes_are_exact(seed, width, peak):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-peak, peak + 1, (7, width)), rng.integers(-peak, peak + 1, (9, width))
    a[0], b[0], b[1] = peak, peak, -peak  # the ends of the range
    primes = primes_for(width, peak)
    assert np.array_equal(Residues(a, primes).times(Residues(b, primes)), a @ b.T)


def test_wide_vectors_are_multiplied_in_strips():
    rng = np.random.default_rng(3)
    a, b = rng.integers(-300, 300, (3, 5000)), rng.integers(-300, 300, (4, 5000))
    assert np.array_equal(Residues(a, PRIMES[:4]).times(Residues(b, PRIMES[:4])), a @ b.T)
    with pytest.raises(ValueError):
        primes_for(64, 1 << 30)


def plain_negatives(rows, every, positives=5, negatives=10, scale=256):
    rows = [r for r in whole(rows) if r[0] is not None and r[2] is not None]
    size = max([len(r[1]) for r in rows], default=0)
    ints = [np.array([int(np.floor(scale * x)) for x in r[1]] + [0] * (size - len(r[1])), np.int64)
            for r in rows]
    out, seen = [], set()
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0], rows[k][2], ints[k].astype(
            "<i4")[:len(rows[k][1])].tobytes())):
        anchor, _, label = rows[k]
        if anchor % every or anchor in seen:
            continue
        seen.add(anchor)
        others = sorted((-int(ints[k] @ ints[j]), rows[j][0], rows[j][2])
                        for j in range(len(rows)) if rows[j][0] != anchor)
        for minus, positive, _ in [o for o in others if o[2] == label][:positives]:
            fit = [o for o in others if o[2] != label and 30 * -minus <= -100 * o[0] <= 90 * -minus]
            out += [(anchor, positive, n + 1, o[1], -minus, -o[0])
                    for n, o in enumerate(fit[:negatives])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("cells, block", [(1 << 20, 4096), (64, 3)])
def test_negatives_as_by_plain_search(spark, monkeypatch, cells, block):
    monkeypatch.setattr(hard_negatives, "CELLS", cells)
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    rows = awkward_vectors(7, n=90)
    df = vectors(spark, rows).repartition(4)
    found = hard_negatives.hard_negatives(df, F.col("vec_id") % 4 == 0)
    assert rows_of(found) == plain_negatives(rows, 4)
    assert found.count() > 50


def test_labels_may_be_an_expression(spark):
    rows = awkward_vectors(9)
    moved = [(i, v, None if k is None else (k + 1) % 3) for i, v, k in rows]
    found = hard_negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 5 == 0,
                                          label=(F.col("label") + 1) % 3)
    assert rows_of(found) == plain_negatives(moved, 5)


def test_negatives_of_nothing(spark):
    for rows in ([], [(1, None, 1)], [(0, [1.0], 1), (1, [1.0], None)], [(1, [1.0], 1)]):
        assert rows_of(hard_negatives.hard_negatives(
            vectors(spark, rows), F.col("vec_id") % 2 == 0)) == []
