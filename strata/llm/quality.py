"""Quality rules: counts over each text, and a hashed n-gram likelihood ratio against the corpus."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import discard_all, in_batches, left_in_place, noted, stage_in_place

GRAM, BITS = 4, 16
LEAST_KEPT = 0.002
STEPS = 4096
SYMBOLS, SPACES = "#*$%&|<>", " \t\n\v\f\r"
COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
           "n_repeat_words long, base_failed boolean, score double, kept boolean")


def buckets(data: bytes, gram: int = GRAM, bits: int = BITS) -> np.ndarray:
    """The bucket of every run of `gram` bytes."""
    raw = np.frombuffer(data, np.uint8).astype(np.uint64)
    n = len(raw) - gram + 1
    if n < 1:
        return np.zeros(0, np.uint32)
    value = raw[:n].copy()
    for k in range(1, gram):
        value = value * np.uint64(257) + raw[k:n + k]
    return ((value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.uint32)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    if len(known) < 1 << 21:
        keys = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
        _, place, times = np.unique(keys, return_inverse=True, return_counts=True)
    else:
        windows = np.stack([ids[:-2], ids[1:-1], ids[2:]], axis=1)
        _, place, times = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
    again = times[place.reshape(-1)] > 1
    inside = np.zeros(len(ids), bool)
    for k in range(3):
        inside[k:len(again) + k] |= again
    return int(inside.sum())


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text; null has no word."""
    text = text or ""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


@dataclass(frozen=True)
class Model:
    """The log ratio of the two multinomials by bucket, and the least mean ratio that is kept."""

    ratio: np.ndarray
    least: float = float("-inf")

    def score(self, text: str | None) -> float:
        """The mean log ratio over the text's n-grams; 0 where it has none."""
        found = buckets((text or "").encode(), GRAM, int(len(self.ratio)).bit_length() - 1)
        return float(self.ratio[found].mean()) if len(found) else 0.0


def _labelled(labels: DataFrame, most: int | None = None) -> DataFrame:
    """Every labelled id, and whether it is counted: trusted, as no label says otherwise. A
    caller may set a bound; no query does."""
    by_id = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
             .agg(F.min("quality").alias("quality")))
    found = by_id.select(F.col("doc_id").alias("labelled"), (F.col("quality") == 1).alias("counted"))
    return found if most is None else found.orderBy(
        F.col("counted").desc(), F.xxhash64("labelled")).limit(most)


def _counted(texts: DataFrame, bits: int) -> np.ndarray:
    """One and the number of the texts' n-grams, by bucket."""
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(buckets((value.as_py() or "").encode(), GRAM, bits),
                                     minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    total = np.ones(size)
    for r in (texts.select("text").mapInArrow(count, "bucket long, n long")
              .groupBy("bucket").agg(F.sum("n").alias("n")).collect()):
        total[r.bucket] += r.n
    return total


def unseen_score(text: str, raw: np.ndarray, target: np.ndarray) -> float:
    """The score of a text that the target counts, as if the target had not seen it."""
    found, times = np.unique(buckets(text.encode(), GRAM, len(raw).bit_length() - 1),
                             return_counts=True)
    if not len(found):
        return 0.0
    n = times.sum()
    ratio = np.log((target[found] - times) / (target.sum() - n)) - np.log(raw[found] / raw.sum())
    return float((ratio * times).sum() / n)


def _least(scores: DataFrame, share: float) -> float | None:
    """A score with a share of all scores below it, or up to 1 / STEPS less: the lowest of its
    step. Every score is counted, and the result does not depend on their order."""
    steps = (scores.groupBy(F.floor(F.col("score") * STEPS).alias("step"))
             .agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
             .orderBy("step").collect())
    left = share * sum(r.n for r in steps)
    for r in steps:
        left -= r.n
        if left <= 0:
            return r.least
    return None


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
        trusted: int | None = None, bits: int = BITS, least_kept: float = LEAST_KEPT) -> Model:
    """The raw multinomial counts the n-grams of all docs, the target one those of all trusted
    documents: labelled with quality 1. The threshold is 0, where the target explains a text as
    well as the corpus does, or less: the lowest score but a share `least_kept` of the trusted
    documents, each scored by the target without its own n-grams. Without a trusted document
    nothing is rejected.

    Ids and labels are joined, and what is chosen travels to the texts, which stay in place: no
    text is shuffled, and no id is held by a task or the driver."""
    with noted() as folders:
        texts = stage_in_place(in_batches(docs).select(
            docs[id].alias("doc_id"), docs[text].alias("text")), "quality-texts")
        known = _labelled(labels, trusted).where("counted")
        found = texts.select("part", "tag", "doc_id").join(
            known, texts["doc_id"] == known["labelled"], "left_semi")
        chosen = left_in_place(texts, found.select("part", "tag"), "left_semi", ["text"], "trusted")
    raw, target = _counted(texts, bits), _counted(chosen, bits)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            passed = []
            for value in batch.column(0).to_pylist():
                found = counts(value)
                if not base_failed(found[0], found[4]):
                    passed.append(unseen_score(value, raw, target))
            yield pa.RecordBatch.from_arrays([pa.array(passed, pa.float64())], ["score"])

    least = _least(chosen.mapInArrow(scored, "score double"), least_kept)
    discard_all(docs.sparkSession, folders)
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    return Model(ratio) if least is None else Model(ratio, min(0.0, least))


def assess(model: Model, text: str | Column) -> Column:
    """The counts, the base rule, the score and the verdict on a text, as a struct."""
    @F.pandas_udf(COLUMNS)
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for value in texts:
            found, score = counts(value), model.score(value)
            failed = base_failed(found[0], found[4])
            rows.append((*found, failed, score, not failed and score >= model.least))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in COLUMNS.split(", ")])

    return of.asNondeterministic()(text)  # else a filter on it would have it run twice


def quality(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
            model: Model | None = None) -> DataFrame:
    """One row per row of docs: doc_id, the counts, base_failed, score, kept. Null text has no
    words and fails the base rule; rows that repeat are each judged; an empty table gives no
    row. Once the model is there, nothing is shuffled."""
    model = model or fit(docs, labels, id, text)
    return in_batches(docs).select(docs[id].alias("doc_id"), assess(model, docs[text]).alias("q")).select(
        "doc_id", "q.*")


def keep_good(docs: DataFrame, labels: DataFrame, id: str = "doc_id",
              text: str = "text") -> DataFrame:
    """The rows of docs that the rules keep, all columns as they are."""
    return docs.where(assess(fit(docs, labels, id, text), docs[text]).getField("kept"))
