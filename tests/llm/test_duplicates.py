"""Exact, SimHash and line duplicates against plain computations."""

import hashlib
import math
import random
import re
import string

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import common, edits, exact, fuzzy_lines, simhash
from strata.llm.components import components
from strata.session import exists

from helpers import Union, awkward, documents, rows_of

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


# Components.

def test_components_of_random_graphs_and_a_long_chain(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges += [(1000 + i, 1001 + i) for i in range(130)] + [(5000, i) for i in range(5001, 5200)]
    edges += [(7, 7), (None, 3), (4, None)] + edges[:20]
    plain = Union()
    for a, b in edges:
        if a is not None and b is not None and a != b:
            plain.join(a, b)
    least = {}
    for x in plain.up:
        least[plain.root(x)] = min(x, least.get(plain.root(x), x))
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert rows_of(found) == rows_of_list((x, least[plain.root(x)]) for x in plain.up)


def rows_of_list(rows):
    return sorted(rows, key=repr)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


# Exact.

def exact_plain(rows):
    """keep_id and group_size by normalised text; None ranks lowest."""
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOW), []).append(i)
    return {k: (max(v, key=lambda x: (x is not None, x or 0)), len(v)) for k, v in groups.items()}


@pytest.mark.parametrize("prefix", [1, 64])
def test_exact_groups(spark, monkeypatch, prefix):
    monkeypatch.setattr(exact, "PREFIX", prefix)
    rows = awkward()
    plain = exact_plain(rows)
    want = [(i, *plain[(t or "").translate(LOW)],
             hashlib.sha256((t or "").translate(LOW).encode()).hexdigest()) for i, t in rows]
    found = exact.exact_groups(documents(spark, rows)).collect()
    assert rows_of_list((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == (
        rows_of_list(want))
    by_text = {}
    for r in found:
        by_text.setdefault(r.text_sha256, []).append(r)
    for group in by_text.values():
        kept = [r for r in group if r.kept]
        assert len(kept) == 1 and kept[0].doc_id == kept[0].keep_id


def test_exact_dedup_keeps_rows_whole(spark):
    rows = awkward()
    docs = documents(spark, rows)
    found = exact.exact_dedup(docs)
    assert found.columns == docs.columns
    plain = exact_plain(rows)
    assert found.count() == len(plain)
    assert {(r.doc_id, (r.text or "").translate(LOW)) for r in found.collect()} == {
        (v[0], k) for k, v in plain.items()}
    assert {tuple(r) for r in found.collect()} <= {tuple(r) for r in docs.collect()}


def test_exact_of_an_empty_table(spark):
    assert exact.exact_groups(documents(spark, [])).count() == 0
    assert exact.exact_dedup(documents(spark, [])).count() == 0


# SimHash.

def print_plain(text, words=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not found:
        return 0
    shingles = [" ".join(found[i:i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.none(), st.text(alphabet="aB \t\n\x0b\x1c\xa0é語.", max_size=60)))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == print_plain(text)


def test_fingerprint_of_a_long_text_is_that_of_its_parts(monkeypatch):
    text = " ".join(str(i % 977) for i in range(3000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "PART", 100)
    assert simhash.fingerprint(text) == whole == print_plain(text)


def near_prints(seed, n):
    """Clusters of fingerprints a few bits around centres, extremes among them."""
    rng = random.Random(seed)
    found = {0, (1 << 64) - 1, 1, 3, 7}
    while len(found) < n:
        centre = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            found.add(centre)
            for _ in range(rng.randrange(3)):
                centre ^= 1 << rng.randrange(64)
    return sorted(found)


def linked(prints, radius):
    plain, values = Union(), np.array(prints, np.uint64)
    for i, x in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ x) <= radius) + i + 1:
            plain.join(prints[i], prints[int(j)])
    return plain


@pytest.mark.parametrize("parts", [1, 2, 4, 8])
def test_links_connect_what_is_near_whatever_the_tiles(spark, parts):
    prints = near_prints(parts, 500)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in prints]
    plain, found = linked(prints, 2), Union()
    pairs = [(a % (1 << 64), b % (1 << 64)) for a, b in
             simhash.links(spark.createDataFrame(signed, "print long"), 2, parts).collect()]
    for a, b in pairs:
        assert (a ^ b).bit_count() <= 2
        found.join(a, b)
    classes = lambda u: {frozenset(x for x in prints if u.root(x) == r)
                         for r in map(u.root, prints)}
    assert classes(found) == classes(plain)


def test_dense_tiles_give_few_links(spark):
    """All fingerprints within one bit of a centre: 64 choose 2 pairs, but a tree is enough."""
    prints = [(0,)] + [((1 << b) - (1 << 64) if b == 63 else 1 << b,) for b in range(64)]
    found = simhash.links(spark.createDataFrame(prints, "print long"), 2, 1)
    assert 64 <= found.count() <= 130


def test_simhash_groups_and_dedup(spark):
    rows = awkward(3, 90)
    rows += [(200 + i, rows[1][1] + f" tail{i % 2}") for i in range(6)]
    prints = {t: print_plain(t) for _, t in rows}
    plain = linked(sorted(set(prints.values())), 2)
    least = {}
    for i, t in rows:
        if i is not None:
            r = plain.root(prints[t])
            least[r] = min(i, least.get(r, i))
    want = [(i, prints[t], least.get(plain.root(prints[t]))) for i, t in rows]
    docs = documents(spark, rows)
    found = [(r.doc_id, r.print % (1 << 64), r.component_id)
             for r in simhash.simhash_groups(docs).collect()]
    assert rows_of_list(found) == rows_of_list(want)
    kept = simhash.simhash_dedup(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    groups = {plain.root(prints[t]) for _, t in rows}
    assert rows_of_list((i,) for i in ids) == rows_of_list((least.get(r),) for r in groups)


def test_full_tiles_are_dealt_to_several_tasks(spark, monkeypatch):
    """All in few tiles, and those cut into shares of three fingerprints."""
    prints = near_prints(3, 200)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in prints]
    whole = spark.createDataFrame(signed, "print long")
    monkeypatch.setattr(simhash, "FULL", 3)
    plain, found = linked(prints, 2), Union()
    for a, b in simhash.links(whole, 2, 1).collect():
        assert ((a ^ b) % (1 << 64)).bit_count() <= 2
        found.join(a % (1 << 64), b % (1 << 64))
    classes = lambda u: {frozenset(x for x in prints if u.root(x) == r)
                         for r in map(u.root, prints)}
    assert classes(found) == classes(plain)


def test_one_group_of_half_the_rows(spark):
    """No task of a join by key reads the whole group: it is decided by a broadcast."""
    rows = [(k, "the same text" if k % 2 else f"text {k} of its own {k * k}") for k in range(3000)]
    docs = documents(spark, rows, clash=False).repartition(8)
    found = {r.doc_id: (r.keep_id, r.group_size) for r in exact.exact_groups(docs).collect()}
    assert found == {k: (2999, 1500) if k % 2 else (k, 1) for k, _ in rows}
    assert exact.exact_dedup(docs).count() == 1501
    assert simhash.simhash_dedup(docs).where("text = 'the same text'").count() == 1
    edges = spark.createDataFrame([(0, k) for k in range(1, 2000)] + [(5000, 5001)],
                                  "a long, b long")
    assert {tuple(r) for r in components(edges).collect()} == {
        (k, 0) for k in range(2000)} | {(5000, 5000), (5001, 5000)}


def test_rows_stay_where_they_are(spark):
    """A join by part and tag moves the decisions, not the rows."""
    docs = documents(spark, [(k, f"text {k}") for k in range(500)], clash=False).repartition(5)
    with common.noted() as folders:
        rows = common.stage_in_place(docs, "rows")
        gone = common.stage(rows.where("doc_id % 3 = 0").select("part", "tag"), "gone")
    spark.conf.set(common.IN_PLACE, "false")
    plan = rows.join(gone.hint("shuffle_hash"), ["part", "tag"], "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset(common.IN_PLACE)
    assert text.count("Exchange") == 1 and "Bucketed: true" in text
    kept = common.left_in_place(rows, gone, "left_anti", ["doc_id"], "kept")
    assert rows_of(kept) == sorted([(k,) for k in range(500) if k % 3], key=repr)
    paths = list(folders)
    common.discard_all(spark, folders)
    assert folders == [] and not any(exists(spark, p) for p in paths)


def test_simhash_of_an_empty_table(spark):
    assert simhash.simhash_groups(documents(spark, [])).count() == 0
    assert simhash.simhash_dedup(documents(spark, [])).count() == 0


# Lines.

def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abc", max_size=14), st.text(alphabet="abc", max_size=14),
       st.integers(0, 15))
def test_edit_distance(a, b, most):
    found = fuzzy_lines.distance(a, b, most)
    assert found == edit(a, b) if edit(a, b) <= most else found > most


def test_edit_distance_of_long_near_texts():
    rng = random.Random(4)
    for _ in range(40):
        a = "".join(rng.choice("abcd ") for _ in range(rng.randrange(300, 900)))
        b = list(a)
        for _ in range(rng.randrange(40)):
            at = rng.randrange(len(b))
            b[at:at + rng.randrange(2)] = rng.choice(["", "x", "yz"])
        b, most = "".join(b), rng.randrange(1, 60)
        want, found = edit(a, b), fuzzy_lines.distance(a, b, most)
        assert found == want if want <= most else found > most


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 2 ** 32), st.sampled_from([1, 3, 63, 64, 65, 130, 400, 700]))
def test_many_edit_distances_at_a_time(seed, n):
    rng, pairs = random.Random(seed), []
    for _ in range(40):
        a = "".join(rng.choice("abc é") for _ in range(n))
        b = list(a)
        for _ in range(int(n * rng.choice([0, 0.02, 0.1, 0.19, 0.21, 0.3, 1]))):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randrange(2)] = rng.choice(["", "x", "yz", "語"])
        pairs.append((a, "".join(b)))
    pairs += [(pairs[0][0], ""), ("", "")]
    assert edits.near_pairs(pairs, 0.8) == [fuzzy_lines.similar(*x) for x in pairs]


def test_beginnings_tell_far_texts_apart_and_lose_no_near_ones():
    """Edits in one stretch at the beginning lead far from the diagonal; edits at the end cost
    nothing until late. Texts that are not alike go by a part of them."""
    rng, pairs = random.Random(6), []

    def text(n):
        return "".join(rng.choice(string.ascii_lowercase) for _ in range(n))

    for k in range(90):
        a = text(rng.randrange(500, 600))
        few = int(len(a) * rng.choice([0.05, 0.15, 0.19, 0.21, 0.25]))
        half = few // 2
        b = [text(few) + a, a[few:], a[half:] + text(half), text(half) + a[:-half],
             a[:-few] + text(few), text(len(a))][k % 6]
        pairs.append((k, *sorted((a, b), key=len), int(0.2 * max(len(a), len(b)) + 1e-9)))
    pairs = [x for x in pairs if len(x[2]) - len(x[1]) <= x[3]]
    pairs.sort(key=lambda x: -len(x[2]))
    near = [edit(a, b) <= most for _, a, b, most in pairs]
    left = edits._together(pairs, True)
    assert all(x for x, alike in zip(left, near, strict=True) if alike)
    assert not any(x for x, (k, *_) in zip(left, pairs, strict=True) if k % 6 == 5)
    assert edits._together(pairs) == near
    assert edits.near_pairs([x[1:3] for x in pairs], 0.8) == near


def test_tables_of_characters_are_split(monkeypatch):
    rng = random.Random(9)
    texts = ["".join(chr(0x4e00 + rng.randrange(3000)) for _ in range(200)) for _ in range(40)]
    pairs = [(x, x[:90] + x[100:] + "ab" if k % 2 else texts[k - 1]) for k, x in enumerate(texts)]
    monkeypatch.setattr(edits, "TABLE", 1 << 15)
    assert edits.near_pairs(pairs, 0.8) == [k % 2 == 1 for k in range(40)]


def test_hashes_of_grams():
    codes = np.random.default_rng(5).integers(0, 1 << 21, 40).astype(np.uint64)
    for gram in (1, 2, 3, 4, 7, 8, 12):
        want = [sum(int(c) * int(fuzzy_lines.GRAM) ** (gram - 1 - j)
                    for j, c in enumerate(codes[k:k + gram])) % 2 ** 64
                for k in range(len(codes) - gram + 1)]
        assert np.array_equal(fuzzy_lines._gram_hashes(codes, gram),
                              fuzzy_lines._mixed(np.array(want, np.uint64)))


def connected_plain(entries):
    """Clusters of (block, line, first bits, step), as sets of lines."""
    found = set()
    for block in {x[0] for x in entries}:
        rows = sorted({x[1:] for x in entries if x[0] == block})
        uf = Union()
        for k, a in enumerate(rows):
            for b in rows[k + 1:]:
                if (abs(a[2] - b[2]) <= math.ceil(-math.log(0.8) / fuzzy_lines.STEP) + 1
                        and (a[1] ^ b[1]).bit_count() <= fuzzy_lines.EARLIER):
                    uf.join(a, b)
        groups = {}
        for a in rows:
            groups.setdefault(uf.root(a), []).append(a[0])
        found |= {tuple(sorted(x)) for x in groups.values() if len(x) > 1}
    return found


def test_entries_of_a_block_are_connected():
    """Lines that repeat count once, also where numbers of lines end in the same bits."""
    rng = random.Random(1)
    prints = [rng.getrandbits(64) for _ in range(6)]
    entries = []
    for block in range(60):
        for _ in range(rng.randrange(1, 9)):
            line, print_ = rng.choice([5, 9, 5 + (1 << 24), 9 + (1 << 30), 7]), rng.choice(prints)
            for _ in range(rng.randrange(16)):
                print_ ^= 1 << rng.randrange(64)
            entries += [(block, line, print_, rng.randrange(8))] * rng.randrange(1, 3)
    packed = b"".join(int(x).to_bytes(n, "little") for row in entries
                      for x, n in zip(row, fuzzy_lines.ENTRY, strict=True))
    out = fuzzy_lines._connected([packed], 0.8).to_pydict()
    found = {}
    for home, cluster, line in zip(out["home"], out["cluster"], out["id"], strict=True):
        found.setdefault((cluster, home), []).append(line)
    assert all(home == min(lines) for (_, home), lines in found.items())
    assert {tuple(sorted(set(x))) for x in found.values()} == {
        tuple(sorted(set(x))) for x in connected_plain(entries)}


def test_distances_of_very_long_texts():
    rng = random.Random(2)
    a = "".join(rng.choice("abcd ") for _ in range(6000))
    near = a[:3000] + "zzz" + a[3001:]
    assert edits.near_pairs([(a, near), (a, a[::-1]), (a, a[:4000])], 0.8) == [True, False, False]


def print_of(line, usual=None):
    """Bit by bit, from the hashes of the line's grams."""
    text = f" {line} "
    hashes = [int(fuzzy_lines._gram_hashes(np.array([ord(c) for c in text[k:k + 4]], np.uint64), 4)[0])
              % fuzzy_lines.BINS for k in range(len(text) - 3)]
    middle = 0 if usual is None else len(hashes) * (usual.astype(float) @ fuzzy_lines.SIGNS)
    return fuzzy_lines.SIGNS[hashes].astype(float).sum(0) - middle > 0


def test_line_fingerprints_bit_by_bit(monkeypatch):
    lines = ["a", "ab", "", "the same line", "the same line", "語学 é " * 20, "x" * 5000]
    usual = np.random.default_rng(1).dirichlet(np.ones(fuzzy_lines.BINS)).astype(np.float32)
    for part in (1 << 16, 40):
        monkeypatch.setattr(fuzzy_lines, "PART", part)
        for middle in (None, usual):
            bits = np.unpackbits(fuzzy_lines.fingerprints(lines, middle).view(np.uint8), axis=1,
                                 bitorder="little")
            for line, found in zip(lines, bits):
                assert (found != print_of(line, middle)).mean() < 0.005  # sums near zero
        few = fuzzy_lines.fingerprints(lines, usual, 64)
        assert np.array_equal(few, fuzzy_lines.fingerprints(lines, usual)[:, :1])


MADE = random.Random(0)
MADE = ["".join(MADE.choices("abcdefghijklmnopqrstuvwxyz", k=MADE.randrange(2, 9)))
        for _ in range(500)]


def variants(seed):
    """Documents of lines of which many are others with a few words changed, one after another."""
    rng, rows = random.Random(seed), []
    for i in range(40):
        lines = []
        for _ in range(rng.randrange(5)):
            line = rng.choices(MADE, k=rng.choice([5, 12, 40]))
            lines.append(" ".join(line))
            for _ in range(rng.randrange(4)):
                line[rng.randrange(len(line))] += rng.choice(["", "s", "!", "é"])
                lines.append(" ".join(line).title())
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    return rows


def lines_plain(rows):
    """Occurrences, and for each the place that its group keeps, by edit similarity alone."""
    found = [((i is None, i or 0), n, fuzzy_lines.normalised(x)) for i, t in rows
             for n, x in enumerate((t or "").split("\n")) if x and not x.isspace()]
    texts, plain, first = sorted({x for _, _, x in found}), Union(), {}
    pairs = [(a, b) for k, a in enumerate(texts) for b in texts[k + 1:]]
    for (a, b), near in zip(pairs, edits.near_pairs(pairs, 0.8)):
        if near:
            plain.join(a, b)
    for i, n, x in found:
        first[plain.root(x)] = min((i, n), first.get(plain.root(x), (i, n)))
    return [(i, n, *first[plain.root(x)]) for i, n, x in found]


@pytest.mark.parametrize("hot, split", [(1000, 20_000), (2, 20_000), (3, 2)])
def test_fuzzy_lines(spark, monkeypatch, hot, split):
    """Also where clusters are dealt to tasks of two lines, and blocks are not looked into."""
    monkeypatch.setattr(fuzzy_lines, "HOT", hot)
    monkeypatch.setattr(fuzzy_lines, "SPLIT", split)
    rows = variants(5) + [(1000 + (i or 0) if i is not None else None, t) for i, t in awkward()]
    unseen = lambda place: (place is None, place or 0)
    want = lines_plain(rows)
    found = fuzzy_lines.fuzzy_lines(documents(spark, rows)).collect()
    assert rows_of_list((unseen(r.doc_id), r.line_no, unseen(r.keep_doc_id), r.keep_line_no)
                        for r in found) == rows_of_list(want)
    groups = {}
    for r in found:
        groups.setdefault(r.class_id, []).append(r)
    for group in groups.values():
        kept = [(r.doc_id, r.line_no) for r in group if r.kept]
        assert kept == [(group[0].keep_doc_id, group[0].keep_line_no)]
    assert any(len({r.line_no for r in g}) > 1 for g in groups.values())


def changed(rng, line, kind):
    words, letters = line.split(" "), list(line)
    if kind == "a word replaced":
        words[rng.randrange(len(words))] = rng.choice(MADE)
        return " ".join(words)
    if kind == "a word left out":
        words.pop(rng.randrange(len(words)))
        return " ".join(words)
    if kind == "an eighth of the words":
        for at in rng.sample(range(len(words)), max(1, len(words) // 8)):
            words[at] = rng.choice(MADE)
        return " ".join(words)
    for at in rng.sample(range(len(letters)), max(1, len(letters) // 10)):  # strewn characters
        letters[at] = rng.choice("abcdefghijklmnopqrstuvwxyz")
    return "".join(letters)


KINDS = ["a word replaced", "a word left out", "an eighth of the words", "a tenth of the characters"]


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("low, high", [(8, 32), (32, 64), (64, 200), (200, 10_000)])
def test_recall_over_lines_of_documents(low, high, kind):
    """Of changed lines that edit similarity alone would link, nine of ten at least share a block
    and pass both looks at the fingerprints."""
    import pyarrow.parquet as pq

    lines = sorted({fuzzy_lines.normalised(x) for t in pq.read_table(
        "/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
        for x in (t or "").split("\n") if x and not x.isspace()})
    total = sum(c.sum(0) for _, _, c in fuzzy_lines._counts(lines))
    usual = (total / total.sum()).astype(np.float32)
    rng, pairs = random.Random(low), []
    pool = [x for x in lines if low <= len(x) < high]
    for _ in range(20_000):
        if len(pairs) < 300:
            a = rng.choice(pool)
            b = changed(rng, a, kind)
            if b and a != b and fuzzy_lines.similar(a, b):
                pairs.append((a, b))
    assert len(pairs) > 100
    sides = [list(x) for x in zip(*pairs)]
    prints = [fuzzy_lines.fingerprints(x, usual) for x in sides]
    shared = []
    for lines, found in zip(sides, prints):
        owner, value = fuzzy_lines.blocks(lines, found)
        shared.append([set(value[owner == k].tolist()) for k in range(len(lines))])
    longer = np.array([max(map(len, x)) for x in pairs])
    near = np.bitwise_count(prints[0] ^ prints[1]).sum(1) <= fuzzy_lines.radius(longer)
    early = np.bitwise_count(prints[0][:, 0] ^ prints[1][:, 0]) <= fuzzy_lines.EARLIER
    both = np.array([bool(a & b) for a, b in zip(*shared)])
    assert (near & early & both).mean() >= 0.9


def test_one_changed_stretch_always_shares_a_bucket():
    for n in range(5, 700):
        for few in range(n - int(0.2 * n + 1e-9), n + 1):
            both = set(fuzzy_lines.ends(n, 0.8)) & set(fuzzy_lines.ends(few, 0.8))
            assert any(k <= fuzzy_lines._half(n, 0.8) for k in both)


def changed_lines(seed, n):
    rng = random.Random(seed)
    made = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 9)))
            for _ in range(500)]
    lines = []
    for _ in range(n):
        line = rng.choices(made, k=rng.choice([4, 6, 10, 20, 50]))
        lines.append(" ".join(line))
        for _ in range(rng.randrange(3)):
            other = list(line)
            for at in rng.sample(range(len(line)), max(1, len(line) // 12)):
                other[at] = rng.choice(made)
            lines.append(" ".join(other))
    return lines


def test_lines_are_linked_by_edit_similarity_alone(spark):
    lines = changed_lines(8, 120)
    plain, first = Union(), {}
    for k, a in enumerate(lines):
        for b in lines[k + 1:]:
            if fuzzy_lines.similar(a, b):
                plain.join(a, b)
    for k, a in enumerate(lines):
        first.setdefault(plain.root(a), k)
    found = fuzzy_lines.fuzzy_lines(documents(spark, list(enumerate(lines)))).collect()
    assert {r.doc_id: r.keep_doc_id for r in found} == {
        k: first[plain.root(a)] for k, a in enumerate(lines)}


def test_turns_share_out_the_blocks():
    """Each turn enters some half of the blocks, both together enter each block once."""
    lines = changed_lines(3, 200)
    prints = fuzzy_lines.fingerprints(lines, bits=fuzzy_lines.FIRST)
    owner, value = fuzzy_lines.blocks(lines, prints)
    turns = [fuzzy_lines.blocks(lines, prints, turn=turn) for turn in fuzzy_lines.TURNS]
    assert sorted(zip(owner.tolist(), value.tolist())) == sorted(
        x for turn in turns for x in zip(*(c.tolist() for c in turn)))
    assert max(len(x) for x, _ in turns) < 0.6 * len(owner)


def test_single_entries_are_left_out():
    rng = np.random.default_rng(2)
    block = rng.integers(0, 3000, 2000).astype(np.uint64) * np.uint64(12_345_678)
    columns = [block, np.arange(2000), rng.integers(0, 1 << 60, 2000), rng.integers(0, 256, 2000)]
    packed = np.concatenate([np.ascontiguousarray(x, "<u8").view(np.uint8).reshape(-1, 8)[:, :n]
                             for x, n in zip(columns, fuzzy_lines.ENTRY)], axis=1).tobytes()
    seen, count = np.unique(block, return_counts=True)
    want = [x for x in zip(*(c.tolist() for c in columns)) if x[0] in set(seen[count > 1].tolist())]
    found = fuzzy_lines._unpacked([packed[:20 * 700], packed[20 * 700:]])
    assert list(zip(*(c.tolist() for c in found))) == want
    assert all(len(c) == 0 for c in fuzzy_lines._unpacked([]))


@pytest.mark.parametrize("hot, many", [(1000, 64), (7, 64), (1000, 0), (7, 0)])
def test_near_pairs_of_clusters(monkeypatch, hot, many):
    """Listed pairs, and all pairs of the lines given for dense clusters, against brute force;
    clusters are dealt to parts of three lines, and read some rows at a time."""
    import pyarrow as pa

    monkeypatch.setattr(fuzzy_lines, "HOT", hot)
    monkeypatch.setattr(fuzzy_lines, "MANY", many)
    rng = np.random.default_rng(3)
    sizes, prints = rng.integers(20, 300, 300), rng.integers(0, 1 << 62, (300, 8)).astype(np.uint64)
    for k in range(0, 300, 3):  # two of three are near the one before, in bits and in length
        sizes[k + 1:k + 3] = sizes[k]
        prints[k + 1:k + 3] = prints[k] ^ (np.uint64(1) << rng.integers(0, 60, (2, 8)).astype(np.uint64))
    rows, want = [], set()
    for cluster, n in enumerate(rng.integers(2, 60, 40).tolist()):
        start = int(rng.integers(0, 300 - n))
        tags = list(range(start, start + n))
        parts = -(-n // 3) if cluster % 2 else 1
        for tag in tags:
            for part in range(tag % parts, parts):
                rows.append((start, cluster, part, part != tag % parts, parts, tag,
                             int(sizes[tag]), prints[tag].tobytes()))
        for a in tags:
            for b in range(a + 1, start + n):
                longer = max(sizes[a], sizes[b])
                if (abs(sizes[a] - sizes[b]) <= int(0.2 * longer + 1e-9)
                        and np.bitwise_count(prints[a] ^ prints[b]).sum() <= fuzzy_lines.radius(longer)):
                    want.add((a, b))
    rows.sort(key=lambda x: (x[:4], x[5]))
    batches = [pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(
        zip(*rows[k:k + 10]), [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(),
                               pa.int64(), pa.int64(), pa.binary()])], names=list("abcdefgh"))
               for k in range(0, len(rows), 10)]
    listed, spots = set(), {}
    for batch in fuzzy_lines._met(iter(batches), 0.8):
        for spot, a, b, apart in zip(*(c.to_pylist() for c in batch.columns)):
            if b < 0:
                spots.setdefault(spot, ([], []))[-1 - b].append(a)
            else:
                assert apart == np.bitwise_count(prints[a] ^ prints[b]).sum()
                listed.add((a, b))
    given = {tuple(sorted((a, b))) for own, guests in spots.values()
             for k, a in enumerate(own) for b in own[k + 1:] + guests}
    assert listed <= want <= listed | given and len(want) > 100
    assert bool(given) == (many == 0) and bool(listed) == (many > 0)


@pytest.mark.parametrize("least", [0.6, 0.8, 0.9])
def test_pairs_about_the_bound(least):
    """Nearly as many edits as may be, a little fewer or more, in places of all kinds."""
    rng, pairs = random.Random(4), []
    for _ in range(600):
        a = rng.choices("abcd", k=rng.choice([40, 70, 130, 300]))
        b = list(a)
        for _ in range(int(len(a) * (1 - least) * rng.choice([0.8, 1, 1.2, 1.5]))):
            at = rng.randrange(len(b))
            b[at:at + rng.randrange(2)] = rng.choices("abcd", k=rng.randrange(2))
        turn = rng.choice([0, 0, rng.randrange(len(b))])
        pairs.append(("".join(a), "".join(b[turn:] + b[:turn])))
    found = edits.near_pairs(pairs, least)
    assert found == [fuzzy_lines.similar(*x, least) for x in pairs]
    assert 100 < sum(found) < 500


def test_dropped_lines_leave_the_rest_as_it_is(spark):
    rows = [(1, "One line here\n\n  two  \nONE line, here!"), (2, None), (3, ""),
            (4, "two\nthree\n"), (4, "three"), (None, "three\nfour")]
    docs = documents(spark, rows)
    found = fuzzy_lines.drop_repeated_lines(docs)
    assert found.columns == docs.columns
    texts = {(r.doc_id, r.text) for r in found.collect()}
    assert {(1, "One line here\n\n  two  "), (2, None), (3, ""), (None, "four")} <= texts
    assert {t for i, t in texts if i == 4} in ({"three\n", ""}, {"", "three"})


def test_lines_of_an_empty_table(spark):
    assert fuzzy_lines.fuzzy_lines(documents(spark, [])).count() == 0
    assert fuzzy_lines.drop_repeated_lines(documents(spark, [])).count() == 0
