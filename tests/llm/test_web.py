"""WARC archives and URL classes against plain computations."""

import base64
import hashlib
import io
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from strata.llm import url_classes, warc
from strata.llm.url_classes import Rule

from helpers import Union, rows_of


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in ("tag", "size", "sha1", "node", "root", "host", "path", "found", "place", "open", "a"):
        df = df.withColumn(name, df["page_id"].cast("string"))
    return df


def page_rows(n=80):
    rng = random.Random(2)
    texts = [f"<html><p>{' '.join(rng.choice(['the', 'of', 'an']) for _ in range(50))}</p>{k}</html>"
             for k in range(30)]
    rows = [(k, f"http://h{k % 7}.example/{k}", rng.choice(texts)) for k in range(n)]
    return rows + [(200, None, ""), (201, "http://x/ y\n\"z\"é", None), (None, "u", texts[0]),
                   (None, None, "only here"), (202, "v", "é語" * 50_000), (3, "again", texts[1]),
                   (203, "w", "P*M\x18\0\0\0\0\r\n\r\nWARC/1.1\r\n")] + rows[:2]


@pytest.mark.parametrize("least", [0, 100])
def test_warc_round_trip(spark, path, least):
    rows = page_rows()
    warc.write_warc(pages(spark, rows), path("w"), least_bytes=least)
    found = warc.read_warc(spark, path("w")).collect()
    groups = {}
    for i, _, t in rows:
        groups.setdefault((t or "").encode(), []).append(i)
    order = lambda i: (i is None, i or 0)
    want = []
    for data, ids in groups.items():
        first, *rest = sorted(ids, key=order)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((first, "response", len(data), digest, None, data))
        for i in rest:
            want.append((i, "revisit", len(data), digest, first, None) if len(data) >= least
                        else (i, "response", len(data), digest, None, data))
    key = lambda r: (order(r[0]), repr(r[1:]))
    assert sorted(((r.page_id, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to,
                    None if r.payload is None else bytes(r.payload)) for r in found),
                  key=key) == sorted(want, key=key)


def test_files_are_plain_frames_behind_the_dictionary(spark, path):
    rows = [(k, f"http://h/{k}", f"<html>page {k} {'common words ' * 40}</html>") for k in range(300)]
    warc.write_warc(pages(spark, rows), path("w"))
    content = bytes(spark.read.format("binaryFile").load(path("w")).first().content)
    assert int.from_bytes(content[:4], "little") == warc.DICTIONARY_FRAME
    size = int.from_bytes(content[4:8], "little")
    known = zstandard.ZstdCompressionDict(content[8:8 + size])
    one = zstandard.ZstdDecompressor(dict_data=known).decompressobj()
    assert one.decompress(content[8 + size:]).startswith(b"WARC/1.1\r\n") and one.unused_data
    whole = zstandard.ZstdDecompressor(dict_data=known).stream_reader(
        io.BytesIO(content), read_across_frames=True).read()
    assert whole.count(b"WARC-Record-ID: <urn:uuid:") == whole.count(b"WARC/1.1\r\n") > 0
    plain = sum(len(zstandard.compress(warc.record(i, 0, u, t.encode(), "00" * 20, None, None), 6))
                for i, u, t in rows)
    stored = sum(r.length for r in spark.read.format("binaryFile").load(path("w")).collect())
    assert stored < plain + size * len(spark.read.format("binaryFile").load(path("w")).collect())


def test_a_changed_payload_is_noticed(spark, path):
    squeeze = zstandard.ZstdCompressor()
    wrong = warc.record(1, 0, "u", b"text", hashlib.sha1(b"other").hexdigest(), None, None)
    with pytest.raises(ValueError):
        list(warc.records(squeeze.compress(wrong)))
    with pytest.raises(ValueError):
        list(warc.records(squeeze.compress(b"nothing of the kind")))


def test_archive_of_an_empty_table(spark, path):
    warc.write_warc(pages(spark, []), path("w"))
    assert warc.read_warc(spark, path("w")).count() == 0


# URLs.

def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    stop = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    return low, rest[end:stop] if stop > end else ""


def rule_of(url, rules):
    h, p = parts(url)
    fits = [r for r in rules if (h == r.host or h.endswith("." + r.host)) and p.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.name), r.verdict == "allow"), default=None)


def node_of(url):
    h, _ = parts(url)
    return h + url.split("://", 1)[1][len(h):].split("#")[0] if h else None


def judged_plain(rows, edges, rules):
    plain = Union()
    for a, b in edges:
        a, b = node_of(a), node_of(b)
        if a and b and a != b:
            plain.join(a, b)
    allowed, blocked = set(), set()
    for x in plain.up:
        rule = rule_of("http://" + x, rules)
        if rule:
            (allowed if rule.verdict == "allow" else blocked).add(plain.root(x))
    out = []
    for i, url, _ in rows:
        rule, at = rule_of(url, rules), node_of(url)
        root = plain.root(at) if at in plain.up else None
        verdict = rule.verdict if rule else (
            "block" if root in blocked and root not in allowed else "allow")
        out.append((i, *parts(url), rule and rule.name, verdict))
    return sorted(out, key=repr)


URLS = ["http://a.example/x", "https://A.example/x#top", "http://b.com/de/1", "http://c.com/fr/2",
        "https://sub.example.org/es/q", "http://example.org/en/17", "http://example.org/en/7",
        "http://org", "http://org/", "nothing", "", None, "x://y?z", "http://UPPER.example/Path?q#f",
        "ftp://é.example/Ä", "http://notexample.org/es/", "http://a://b/c", "http:///path",
        "http://d.example/", "http://e.example/"]


def test_rules_and_redirects(spark):
    rng = random.Random(8)
    for turn in range(3):
        rows = [(n, u, None) for n, u in enumerate(URLS)] + [(None, URLS[0], ""), (3, URLS[3], "x")]
        known = [u for u in URLS if u] + [f"http://r{k}.example/" for k in range(6)]
        edges = [(rng.choice(known), rng.choice(known)) for _ in range(4 * turn)] + [(None, URLS[0])]
        redirects = spark.createDataFrame(edges, "source string, target string")
        found = url_classes.filter_urls(pages(spark, rows), redirects=redirects)
        assert rows_of(found) == judged_plain(rows, edges, url_classes.RULES)


def test_links_in_html(spark):
    html = {
        1: "<html><LINK href='/y' rel=canonical></html>",
        2: '<meta http-equiv="refresh" content="0; URL=http://b.example.org/es/1">',
        3: '<link\nrel="canonical"\nhref="//d.net/q?a=1&amp;b=2">',
        4: '<link rel=canonical href="http://e.com/fr/z"/>',
        5: '<link rel="stylesheet" href="/es/"><link rel="canonical" href="q">',
        6: "<meta http-equiv=refresh content='5'><a href='/z'>", 7: None}
    urls = {1: "http://a.net/x", 2: "https://A.net/y#f", 3: "http://c.net/", 4: "http://d.net/q?a=1&b=2",
            5: "ftp://z.net/dir/p", 6: "http://z.net/dir/q", 7: "http://k.net"}
    found = url_classes.page_links(pages(spark, [(n, urls[n], html[n]) for n in html]))
    assert rows_of(found) == [
        ("a.net/x", "a.net/y"), ("a.net/y", "b.example.org/es/1"), ("c.net/", "d.net/q?a=1&b=2"),
        ("d.net/q?a=1&b=2", "e.com/fr/z"), ("z.net/dir/p", "z.net/dir/q")]
    rows = [(n, urls[n], html[n]) for n in html]
    verdicts = {r.page_id: r.verdict for r in url_classes.filter_urls(pages(spark, rows)).collect()}
    assert verdicts == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "allow",
                        7: "allow"}


def test_allow_comes_first_among_rules_of_one_length(spark):
    rules = [Rule("block", "a.example", "/x"), Rule("allow", "a.example", "/x")]
    found = url_classes.filter_urls(pages(spark, [(1, URLS[0], None)]), rules).first()
    assert (found.rule, found.verdict) == ("a.example/x", "allow")


def test_urls_of_an_empty_table(spark):
    assert url_classes.filter_urls(pages(spark, [])).count() == 0


def test_addresses_of_one_page_are_one_node(spark):
    want = {"http://A.org": "a.org", "http://a.org/": "a.org/", "http://a.org?x=/../y#z": "a.org?x=/../y",
            "http://a.org/b/../c": "a.org/c", "http://a.org/b/./c/": "a.org/b/c/",
            "http://a.org/b/c/..": "a.org/b/", "http://a.org/b/.": "a.org/b/",
            "http://a.org/../../c?q": "a.org/c?q", "http://a.org/..": "a.org/",
            "http://a.org/b..c/.d/...": "a.org/b..c/.d/...", "http://a.org//b//../c": "a.org//b/c",
            "a.org/b": None, "http:///b": None, None: None}
    rows = spark.createDataFrame([(u,) for u in want], "url string")
    got = {r.url: r.node for r in rows.select("url", url_classes.node(F.col("url")).alias("node")).collect()}
    assert got == want


def test_links_in_lists_and_relative_links_carry_a_block(spark):
    rules = (url_classes.Rule("block", "bad.net", "/x/"),)
    rows = [(1, "http://one.net/p", '<link rel="nofollow canonical" href="http://bad.net/x/1">'),
            (2, "http://two.net/", '<link href="http://bad.net/y/../x/2" rel="canonical">'),
            (3, "http://three.net/a/b", "<link rel='canonical shortlink' href='../../c'>"),
            (4, "http://three.net/c", '<link rel=canonical href="http://two.net/">'),
            (5, "http://four.net/", '<link rel="not-canonical" href="http://bad.net/x/1">'),
            (6, "http://five.net/", '<link rel="canonicalx" href="http://bad.net/x/1">'),
            (7, "http://six.net/", '<link rel="next" title="canonical" href="http://bad.net/x/1">')]
    found = {r.page_id: r.verdict for r in url_classes.filter_urls(pages(spark, rows), rules).collect()}
    assert found == {1: "block", 2: "block", 3: "block", 4: "block",
                     5: "allow", 6: "allow", 7: "allow"}
