"""The corpus pipeline: documents to packed sequences, one written table per stage."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import exact, packing, pii, quality, simhash
from strata.llm.common import discard, discard_all, noted, stage
from strata.llm.queries import op3_pieces, table, vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_stored: list[str] = []  # the folders of the stage before, which its rows may still read


def _clean(function: Stage) -> Stage:
    """What a stage has stored on its way goes when the next begins, as its rows are written
    then; but nothing that the next one's docs read."""
    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = {name.rsplit("/", 2)[1] for name in docs.inputFiles()}
        kept = [f for f in _stored if f.rsplit("/", 1)[1] in read]
        _stored[:] = [f for f in _stored if f not in kept]
        discard_all(spark, _stored)
        with noted() as folders:
            out = function(spark, docs, sf_dir)
        _stored.extend(kept + folders)
        return out

    return run


@_clean
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or that the corpus explains better than the trusted
    documents among them go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


@_clean
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for the case of A-Z, the one with the largest id stays."""
    return exact.exact_dedup(docs)


@_clean
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked, the one with the least id stays."""
    return simhash.simhash_dedup(docs)


@_clean
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kind; every document stays."""
    return pii.redact(docs)


@_clean
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences, as op3_packing returns them."""
    return op3_pieces(packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), end=0))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("pack", pack),
]

# Likelihood ratios, fingerprints and tokens are beyond SQL; tests hold the stages against brute
# force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
