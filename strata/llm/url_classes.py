"""URL filters: rules by host and path, and decisions carried along redirects and canonical links."""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stage
from strata.llm.components import components


class Rule(NamedTuple):
    """allow or block what lies on a host or its subdomains below a path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"),
         Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"),
         Rule("block", "com", "/de/"))

TAG = r"(?i)<(?:link|meta)\b[^>]*>"
# rel holds a list of words; without quotes it is a single one.
CANONICAL = (r"""(?i)^<link\b.*\brel\s*=\s*(?:canonical[\s/>]|"(?:[^"]*\s)?canonical(?:\s[^"]*)?\""""
             r"""|'(?:[^']*\s)?canonical(?:\s[^']*)?')""")
REFRESH = r"""(?i)^<meta\b.*\bhttp-equiv\s*=\s*["']?refresh\b"""
HREF = r"""(?i)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
TARGET = r"""(?i)\burl\s*=\s*['"]?([^'">\s]+)"""


def _part(url: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://" + pattern, 1), F.lit(""))


def host(url: Column) -> Column:
    """What stands between the first :// and the next /, ? or #; A-Z lower-cased; else empty."""
    return F.translate(_part(url, "([^/?#]*)"), ascii_uppercase, ascii_lowercase)


def path(url: Column) -> Column:
    """What follows the host, up to ? or #."""
    return _part(url, "[^/?#]*([^?#]*)")


def _plain(of_path: Column) -> Column:
    """A path without `.` and `..`: one step stays where it is, the other goes up one. An empty
    path stays empty, as no rule with a path fits it."""
    steps = F.split(of_path, "/", -1)
    walked = F.aggregate(steps, F.slice(steps, 1, 0), lambda done, step: (
        F.when(step == ".", done)
        .when(step == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
        .otherwise(F.concat(done, F.array(step)))))
    ended = F.when(of_path.rlike(r"/\.\.?$"), F.lit("/")).otherwise(F.lit(""))
    dotted = F.concat(F.array_join(walked, "/"), ended)
    return F.when(of_path.rlike(r"/\.\.?(?:/|$)"), dotted).otherwise(of_path)


def node(url: Column) -> Column:
    """The address that stands for a page: host, path without `.` and `..`, and query. Null
    where there is no host."""
    return F.when(host(url) != "", F.concat(
        host(url), _plain(path(url)), _part(url, r"[^/?#]*[^?#]*(\?[^#]*)")))


def judged(of_host: Column, of_path: Column, rules: Sequence[Rule]) -> Column:
    """The place in `ranked(rules)` of the first rule that fits; null if none does."""
    chosen = F.lit(None).cast("int")
    for place, rule in reversed(list(enumerate(ranked(rules)))):
        fits = ((of_host == rule.host) | of_host.endswith("." + rule.host)) & of_path.startswith(
            rule.path)
        chosen = F.when(fits, place).otherwise(chosen)
    return chosen


def ranked(rules: Sequence[Rule]) -> list[Rule]:
    """The longest first; of the same length an allowing one."""
    return sorted(rules, key=lambda r: (-len(r.name), r.verdict != "allow", r))


def target(tag: Column) -> Column:
    """The address that a tag names as the page's own: a canonical link's, or that of a refresh
    to another address. Empty for any other tag."""
    return (F.when(tag.rlike(CANONICAL),
                   F.concat(*[F.regexp_extract(tag, HREF, k) for k in (1, 2, 3)]))
            .when(tag.rlike(REFRESH), F.regexp_extract(tag, TARGET, 1)).otherwise(F.lit("")))


def resolved(to: Column, of_host: Column, of_path: Column) -> Column:
    """A target as a whole address, seen from the page that names it."""
    plain = F.replace(F.trim(to), F.lit("&amp;"), F.lit("&"))
    folder = F.when(of_path == "", F.lit("/")).otherwise(F.regexp_extract(of_path, "^.*/", 0))
    return (F.when(plain.rlike("(?i)^https?://"), plain)
            .when(plain.startswith("//"), F.concat(F.lit("http:"), plain))
            .when(plain.startswith("/"), F.concat(F.lit("http://"), of_host, plain))
            .otherwise(F.concat(F.lit("http://"), of_host, folder, plain)))


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges (a, b) between the addresses of pages and those their html names."""
    tags = pages.select(pages[url].alias("url"), F.explode(
        F.regexp_extract_all(pages[html], F.lit(TAG), F.lit(0))).alias("tag"))
    named = stage(tags.select("url", target(F.regexp_replace("tag", r"[\r\n]+", " "))
                              .alias("target")).where("target <> ''"), "named")
    own = named.select("target", node(F.col("url")).alias("a"), host(F.col("url")).alias("host"),
                       path(F.col("url")).alias("path"))
    return own.select("a", node(resolved(F.col("target"), F.col("host"), F.col("path")))
                      .alias("b"))


def filter_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, id: str = "page_id",
                url: str = "url", html: str = "html", redirects: DataFrame | None = None
                ) -> DataFrame:
    """One row per row of pages: page_id, host, path, rule, verdict.

    A page's own rule decides. Pages without one go with their class: all addresses connected
    by canonical links and refreshes in html, and by the rows (source, target) of `redirects`,
    whether or not a page has them. If a rule allows an address of the class they are allowed,
    else if a rule blocks one they are blocked, else allowed.

    Null urls and urls without :// have an empty host and path, fit no rule, belong to no class
    and are allowed; null html names nothing; rows that repeat are each judged; other columns
    are not looked at; an empty table gives an empty result. The rules are an argument and so a
    list of bounded size. Only pages that no rule fits are joined, with one row per address that
    has an edge."""
    edges = page_links(pages, url, html)
    if redirects is not None:
        edges = edges.unionAll(redirects.select(node(redirects["source"]).alias("a"),
                                                node(redirects["target"]).alias("b")))
    classes = stage(components(stage(edges, "url-edges")), "aliases")
    order = ranked(rules)
    verdicts = F.array(*[F.lit(r.verdict) for r in order])
    at = F.concat(F.lit("http://"), F.col("node"))
    found = classes.select("root", host(at).alias("host"), path(at).alias("path")).select(
        "root", F.get(verdicts, judged(F.col("host"), F.col("path"), rules)).alias("verdict"))
    decided = found.groupBy("root").agg(
        F.max(F.col("verdict") == "allow").alias("allowed"),
        F.max(F.col("verdict") == "block").alias("blocked"))
    blocked = classes.join(decided.where("blocked AND coalesce(NOT allowed, true)"), "root").select(
        F.col("node").alias("blocked_node"))
    rows = pages.select(pages[id].alias("page_id"), host(pages[url]).alias("host"),
                        path(pages[url]).alias("path"), node(pages[url]).alias("node"))
    rows = rows.withColumn("place", judged(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("open", F.when(F.col("place").isNull(), F.col("node")))
    by_class = F.when(F.col("blocked_node").isNotNull(), "block").otherwise("allow")
    return rows.join(blocked, F.col("open") == F.col("blocked_node"), "left").select(
        "page_id", "host", "path",
        F.get(F.array(*[F.lit(r.name) for r in order]), F.col("place")).alias("rule"),
        F.coalesce(F.get(verdicts, F.col("place")), by_class).alias("verdict"))
