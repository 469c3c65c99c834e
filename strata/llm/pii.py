"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import in_batches

KINDS = ("email", "ip", "card", "phone")
LABELS = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]
K = len(LABELS)
WINDOWS, AROUND = 400, 40
FEATURES, ROUNDS, RATE, SHRINK = 1 << 13, 80, 0.2, 0.02
CELLS = 1 << 16
SHAPES = 150_000
EDGES = ".,;:!?<>[]\"'"

Span = tuple[str, int, int]

# Leftmost non-overlapping matches of the kinds' patterns. A run of digits is entered at its
# first digit only and an address at its @, so long runs take no more time than short ones.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
PATTERNS = ("ip", IP), ("card", CARD), ("phone", PHONE)
# What the field adds must look like this as a whole, and pass the same checks.
WHOLE = {"email": re.compile(r"[^@]+@[^@]+\.[^@]+"), "ip": re.compile(r"[0-9]+(?:\.[0-9]+){3}"),
         "card": re.compile(r"[0-9][\x20.0-9-]+[0-9]"),
         "phone": re.compile(r"[+(0-9][\x20()./0-9-]+[0-9]")}
ODD, SPACES = re.compile("[0-9@]"), " \t\n\v\f\r"
SPACE = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARACTERS:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield "email", start, done
        at = text.find("@", max(done, at + 1))


def _checked(kind: str, text: str) -> bool:
    """Whether a match has what its kind asks for beside the pattern."""
    if kind == "ip":
        return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255
                   for x in text.split("."))
    digits = re.sub("[^0-9]", "", text)
    if kind == "card":
        return 16 <= len(digits) <= 19 and _luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text: str) -> list[Span]:
    """The spans of the patterns whose matches pass their checks, by kind and start."""
    found = list(_emails(text))
    for kind, pattern in PATTERNS:
        found += [(kind, *m.span()) for m in pattern.finditer(text) if _checked(kind, m.group())]
    return found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(
        spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def parsed(spans: str) -> list[Span]:
    return [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in spans.split(",") if s)]


# Words to features.

CLASS = bytes(ord("9") if 48 <= b < 58 else ord("X") if 65 <= b < 91 else
              ord("x") if 97 <= b < 123 or b > 127 else b for b in range(256))
LETTERS, RUNS, LONG = re.compile(rb"[xX]+"), re.compile(rb"(.)\1+"), re.compile(rb"9{20,}")


def shape(word: bytes) -> bytes:
    """Letter runs as x, digits as 9 each (runs of 20 and more as one N), the rest as it is."""
    return LONG.sub(b"N", LETTERS.sub(b"x", word.translate(CLASS)))


def features(shape_: bytes) -> list[tuple[str, bytes]]:
    plain = RUNS.sub(rb"\1", shape_)
    digits = shape_.count(b"9")
    size = str(digits if digits < 5 else 5 + sum(digits > n for n in (7, 12, 15, 19))).encode()
    return [("whole", shape_[:40]), ("plain", plain[:40]), ("digits", size),
            ("first", shape_[:1]), ("last", shape_[-1:]), ("at", str(shape_.count(b"@")).encode()),
            ("dots", str(min(4, shape_.count(b"."))).encode())]


def places(shape_: bytes, side: str) -> list[int]:
    """Hashed features of a word as seen from itself or from a neighbour."""
    own = features(shape_)
    chosen = own if side == "own" else own[1:3]
    return [zlib.crc32(f"{side}|{name}|".encode() + value) % FEATURES for name, value in chosen]


@dataclass
class Field:
    """Weights of the chain: of features by label, and from label to label."""

    weights: np.ndarray
    follows: np.ndarray
    begins: np.ndarray


ALLOWED = np.array([[b[0] != "I" or a[1:] == b[1:] and a != "O" for b in LABELS] for a in LABELS])
NEVER = -1e4


class Scorer:
    """Scores of words by shape, from tables that grow with the shapes met."""

    def __init__(self, model: Field) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.words: dict[bytes, int] = {}
        self.ids: dict[bytes, int] = {}
        self.tables = np.zeros((3, 1024, K), np.float32)

    def number(self, word: bytes) -> int:
        found = self.words.get(word)
        if found is None:
            known = shape(word)
            found = self.ids.get(known)
            if found is None:
                found = self.ids[known] = len(self.ids)
                if found >= self.tables.shape[1]:
                    self.tables = np.concatenate([self.tables, np.zeros_like(self.tables)], axis=1)
                for k, side in enumerate(("own", "left", "right")):
                    self.tables[k, found] = self.model.weights[places(known, side)].sum(0)
            self.words[word] = found
        return found

    def numbers(self, lines: list[list[bytes]]) -> np.ndarray:
        if len(self.words) > SHAPES:
            if len(self.ids) > SHAPES // 2:
                self._forget()
            self.words = {}
        get = self.number
        return np.array([get(w) for line in lines for w in line], np.int64)

    def scores(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """A word's own score and what its neighbours in the line add."""
        own, left, right = self.tables
        out = own[ids]
        ends = np.cumsum(lengths)
        inner = np.ones(len(ids), bool)
        inner[ends - lengths] = False  # first words have nothing to the left
        out[inner] += left[ids[np.flatnonzero(inner) - 1]]
        inner[:] = True
        inner[ends - 1] = False
        out[inner] += right[ids[np.flatnonzero(inner) + 1]]
        return out


def viterbi(scores: np.ndarray, lengths: np.ndarray, model: Field) -> np.ndarray:
    """The best labels of all lines, whose words follow each other in `scores`; many lines of
    like length at a time."""
    labels = np.zeros(len(scores), np.int8)
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    at = 0
    while at < len(order):
        tall = int(lengths[order[at]])
        some = order[at:at + max(1, CELLS // tall)]
        at += len(some)
        sizes, firsts = lengths[some], starts[some]
        live = np.searchsorted(-sizes, -np.arange(tall), "left")
        back = np.zeros((tall, len(some), K), np.int8)
        best = scores[firsts] + model.begins
        last = np.empty_like(best)
        for t in range(1, tall):
            n = int(live[t])
            last[n:len(best)] = best[n:]
            through = best[:n, :, None] + model.follows[None]
            back[t, :n] = through.argmax(1)
            best = through.max(1) + scores[firsts[:n] + t]
        last[:len(best)] = best
        now = last.argmax(1)
        for t in range(tall - 1, -1, -1):
            n = int(live[t])
            labels[firsts[:n] + t] = now[:n]
            if t:
                now[:n] = back[t, np.arange(n), now[:n]]
    return labels


# Training.

def _words(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in WORD.finditer(text)]


def gold(text: str, spans: list[Span]) -> list[int]:
    """The label of each word of a text whose personal data are known."""
    found = []
    for a, b in _words(text):
        over = next((s for s in spans if s[1] < b and a < s[2]), None)
        found.append(0 if over is None else LABELS.index(
            ("B-" if over[1] >= a else "I-") + over[0]))
    return found


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def fit(labelled: list[tuple[str, list[Span]]]) -> Field:
    """Train on texts with their spans, by gradient ascent on the likelihood of all texts'
    labels under an L2 penalty. The result depends on the texts alone."""
    blocked = np.where(ALLOWED, 0.0, NEVER)
    begin_block = np.array([NEVER if x[0] == "I" else 0.0 for x in LABELS])
    texts = [(t, gold(t, s)) for t, s in labelled]
    texts = [(t, g) for t, g in texts if g]
    weights = np.zeros((FEATURES, K))
    follows, begins = np.zeros((K, K)), np.zeros(K)
    if not texts:
        begins[1:] = NEVER
        return Field(weights.astype(np.float32), (follows + blocked).astype(np.float32),
                     (begins + begin_block).astype(np.float32))
    n, tall = len(texts), max(len(g) for _, g in texts)
    wide = len(places(b"", "own")) + 2 * len(places(b"", "left"))
    active = np.full((n, tall, wide), FEATURES, np.int64)  # one past the end: no feature
    want, live = np.zeros((n, tall), np.int64), np.zeros((n, tall), bool)
    for i, (text, labels) in enumerate(texts):
        shapes = [shape(text[a:b].encode()) for a, b in _words(text)]
        for t, known in enumerate(shapes):
            row = places(known, "own")
            row += places(shapes[t - 1], "left") if t else []
            row += places(shapes[t + 1], "right") if t + 1 < len(shapes) else []
            active[i, t, :len(row)] = row
        want[i, :len(labels)], live[i, :len(labels)] = labels, True
    lengths = live.sum(1)
    rows = np.arange(n)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (weights, follows, begins)]
    hot = np.eye(K)[want] * live[..., None]
    pairs = np.einsum("ita,itb->ab", hot[:, :-1], hot[:, 1:])
    for turn in range(1, ROUNDS + 1):
        score = np.concatenate([weights, np.zeros((1, K))])[active].sum(2)
        move = follows + blocked
        ahead = np.zeros((n, tall, K))
        ahead[:, 0] = score[:, 0] + begins + begin_block
        for t in range(1, tall):
            step = _logsum(ahead[:, t - 1, :, None] + move, 1) + score[:, t]
            ahead[:, t] = np.where(live[:, t, None], step, ahead[:, t - 1])
        behind = np.zeros((n, tall, K))
        for t in range(tall - 2, -1, -1):
            step = _logsum(move + (score[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(live[:, t + 1, None], step, 0.0)
        total = _logsum(ahead[rows, lengths - 1], 1)
        chance = np.exp(ahead + behind - total[:, None, None]) * live[..., None]
        both = np.zeros((K, K))
        for t in range(1, tall):
            joint = (ahead[:, t - 1, :, None] + move + (score[:, t] + behind[:, t])[:, None, :]
                     - total[:, None, None])
            both += (np.exp(joint) * live[:, t, None, None]).sum(0)
        error = (hot - chance).reshape(-1, K)
        up = np.zeros((FEATURES + 1, K))
        flat = active.reshape(-1, wide)
        for c in range(K):
            up[:, c] = np.bincount(flat.ravel(), np.repeat(error[:, c], wide),
                                   minlength=FEATURES + 1)
        slopes = (up[:-1] / n - SHRINK / n * weights, (pairs - both) / n - SHRINK / n * follows,
                  (hot[:, 0] - chance[:, 0]).mean(0) - SHRINK / n * begins)
        for value, slope, moment in zip((weights, follows, begins), slopes, moments, strict=True):
            moment[0][:] = 0.9 * moment[0] + 0.1 * slope
            moment[1][:] = 0.99 * moment[1] + 0.01 * slope * slope
            value += RATE * (moment[0] / (1 - 0.9 ** turn)) / (
                np.sqrt(moment[1] / (1 - 0.99 ** turn)) + 1e-6)
    return Field(weights.astype(np.float32), (follows + blocked).astype(np.float32),
                 (begins + begin_block).astype(np.float32))


def windows(text: str) -> Iterator[tuple[str, str]]:
    """Stretches of a text to learn from, with the spans of the patterns in them: the beginning,
    and around each digit or @ that the stretch before does not hold."""
    spans, done = base_spans(text), 0
    for at in [0, *(m.start() for m in ODD.finditer(text))]:
        if at < done:
            continue
        low, high = max(0, at - AROUND), min(len(text), at + 2 * AROUND)
        for _, a, b in spans:
            low, high = b if a < low < b else low, a if a < high < b else high
        first = SPACE.search(text, low, high) if low else None
        low = first.end() if first else low
        last = max(text.rfind(c, low, high) for c in SPACES) if high < len(text) else high
        done = max(at + 1, last)
        if last > low:
            inside = [(k, a - low, b - low) for k, a, b in spans if low <= a and b <= last]
            yield text[low:last], joined(inside)


def label_table(docs: DataFrame, text: str = "text", most: int = WINDOWS) -> DataFrame:
    """A small labelled table (text, spans) from docs: at most `most` stretches, half of them
    with spans of the patterns, chosen by a hash of the text. Every document takes part."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [w for v in batch.column(0) for w in windows(v.as_py() or "")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w[k] for w in found], pa.string()) for k in range(2)],
                ["text", "spans"])

    found = in_batches(docs).select(docs[text].alias("text")).mapInArrow(of, "text string, spans string")
    ranked = found.distinct().withColumn("rank", F.xxhash64("text"))
    half = lambda rows: rows.orderBy("rank", "text").limit(most // 2).drop("rank")
    return half(ranked.where("spans <> ''")).unionAll(half(ranked.where("spans = ''")))


def train(labelled: DataFrame) -> Field:
    """Fit the field on a small labelled table (text, spans)."""
    rows = sorted(tuple(r) for r in labelled.select("text", "spans").collect())
    return fit([(t, parsed(s)) for t, s in rows])


# Application.

@dataclass
class Finder:
    """Finds spans in many texts at a time: the patterns', and those the field adds."""

    model: Field
    scorer: Scorer = field(init=False)

    def __post_init__(self) -> None:
        self.scorer = Scorer(self.model)

    def __reduce__(self):
        return Finder, (self.model,)

    def added(self, texts: list[str]) -> dict[int, list[Span]]:
        """By text, the spans that the best labelling has and that pass their kind's checks."""
        split = [t.encode().split(b"\n") for t in texts]
        lines = [line.split() for whole in split for line in whole]
        lengths = np.array([len(x) for x in lines], np.int64)
        full = lengths > 0
        owner = np.repeat(np.arange(len(texts)), [len(s) for s in split])[full]
        lines, lengths = [x for x in lines if x], lengths[full]
        if not lines:
            return {}
        ids = self.scorer.numbers(lines)
        labels = viterbi(self.scorer.scores(ids, lengths), lengths, self.model)
        of_word = np.repeat(owner, lengths)
        out = {}
        for n in np.unique(of_word[labels != 0]).tolist():
            a, b = np.searchsorted(of_word, [n, n + 1])
            out[n] = self._spans(texts[n], labels[a:b])
        return out

    @staticmethod
    def _spans(text: str, labels: np.ndarray) -> list[Span]:
        words, spans, at = _words(text), [], 0
        while at < len(labels):
            if labels[at]:
                last = at
                while last + 1 < len(labels) and LABELS[labels[last + 1]][0] == "I":
                    last += 1
                a, b = words[at][0], words[last][1]
                while a < b and text[a] in EDGES:
                    a += 1
                while a < b and text[b - 1] in EDGES:
                    b -= 1
                kind = LABELS[labels[at]][2:]
                if WHOLE[kind].fullmatch(text, a, b) and _checked(kind, text[a:b]):
                    spans.append((kind, a, b))
                at = last
            at += 1
        return spans

    def find(self, texts: list[str | None]) -> list[tuple[list[Span], list[Span]]]:
        """Of each text the patterns' spans, and those added that touch none of them."""
        plain = [t or "" for t in texts]
        base = [base_spans(t) for t in plain]
        more = self.added(plain)
        return [(found, [s for s in more.get(n, ()) if all(
            s[2] <= b[1] or b[2] <= s[1] for b in found)]) for n, found in enumerate(base)]


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; spans that overlap are one."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


COLUMNS = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
           "spans string, n_added long")


def _many(finder: Finder, texts: pd.Series) -> Iterator[tuple]:
    for at in range(0, len(texts), 500):
        part = texts.iloc[at:at + 500].tolist()
        yield from zip(part, finder.find(part), strict=True)


def spotted(model: Field, text: str | Column) -> Column:
    finder = Finder(model)

    @F.pandas_udf(COLUMNS)
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for _, (base, more) in _many(finder, texts):
            kinds = [s[0] for s in base]
            rows.append((*(kinds.count(k) for k in KINDS),
                         hashlib.sha256(joined(base).encode()).hexdigest(),
                         joined(base + more), len(more)))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in COLUMNS.split(", ")])

    return of.asNondeterministic()(text)  # else a filter on it would have it run twice


def find_personal(docs: DataFrame, id: str = "doc_id", text: str = "text",
                  model: Field | None = None) -> DataFrame:
    """One row per row of docs: doc_id, how many spans of each pattern, a digest of them, all
    spans, and how many the field added. Places are code points, ends exclusive.

    Null text is empty and has no span; rows that repeat are each searched; an empty table gives
    no row; other columns are not looked at. Nothing is shuffled but the candidates for the
    labelled table, of which a bounded number reaches the driver. The field sees whole lines of
    whole texts."""
    model = model or train(label_table(docs, text))
    return in_batches(docs).select(docs[id].alias("doc_id"), spotted(model, docs[text]).alias("p")).select(
        "doc_id", "p.*")


def redact(docs: DataFrame, text: str = "text", model: Field | None = None) -> DataFrame:
    """docs with every span replaced by its kind in brackets; null text stays null. A column
    n_chars, where there is one, counts the characters of the new text."""
    finder = Finder(model or train(label_table(in_batches(docs), text)))

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([None if value is None else redacted(value, base + more)
                          for value, (base, more) in _many(finder, texts)], dtype=object)

    out = docs.withColumn(text, of(docs[text]))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length(text).cast(docs.schema["n_chars"].dataType))
    return out
