"""The registered queries against their SQL, and the pipeline against its stages' rules."""

import re

import pytest

import __spark_entry__ as contract
import check_queries
import corpus_pipeline
from strata.llm import oracle, pii, queries, simhash
from strata.llm.quality import base_failed, counts
from strata.session import exists

from helpers import CLASHING, SF, rows_of

NAMES = list(queries.QUERIES)


def test_all_queries_and_the_pipeline_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in NAMES) == list(range(1, 14))
    assert {*NAMES, "pipeline"} <= set(contract.queries())
    assert set(oracle.SQL) <= set(NAMES)


@pytest.mark.parametrize("name", list(oracle.SQL))
def test_query_agrees_with_sql(spark, name):
    assert check_queries.compare(spark, check_queries.database(SF), SF, name) is None


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    for name, function in corpus_pipeline.STAGES[:-1]:
        function(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        assert len(after) == docs.count() and set(after) <= set(before)
        if name == "quality_rules":
            verdicts = {r.doc_id: r.kept for r in queries.op8_quality(spark, SF).collect()}
            assert set(after) == {n for n, kept in verdicts.items() if kept}
            assert not any(base_failed(counts(r.text)[0], counts(r.text)[4]) for r in after.values())
        elif name == "exact_dedup":
            low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
            last = {}
            for n, r in before.items():
                last[low(r.text)] = max(n, last.get(low(r.text), n))
            assert set(after) == set(last.values())
        elif name == "near_dedup":
            prints = {n: simhash.fingerprint(r.text) for n, r in before.items()}
            near = lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2
            assert not any(near(a, b) for a in after for b in after if a < b)
            assert all(any(near(n, m) for m in before if m != n) for n in set(before) - set(after))
        else:
            assert set(after) == set(before)
            for n, r in after.items():
                assert pii.base_spans(r.text) == [] and r.n_chars == len(r.text)
                if not pii.base_spans(before[n].text):
                    assert r.text == before[n].text
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} == set(before)
    assert rows_of(packed.select("doc_id", "start", "length")) != []


def test_run(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.count() > 0 and "sequence_id" in found.columns


def rows_of_ids(ids):
    return sorted(ids, key=repr)


def test_stages_remove_what_the_one_before_stored(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stored = []
    for name, function in corpus_pipeline.STAGES[1:4]:
        out = function(spark, docs, SF)
        assert not any(exists(spark, f) for f in stored if f not in corpus_pipeline._stored)
        stored = list(corpus_pipeline._stored)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    # Rows that have not been written are not taken away from the next stage.
    lazy = corpus_pipeline.exact_dedup(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    n = lazy.count()
    assert corpus_pipeline.near_dedup(spark, lazy, SF).count() <= n == lazy.count()


def test_stages_take_awkward_and_empty_tables(spark):
    rows = [(1, None, "en", "s", 0), (2, "", "en", None, 0), (3, "word " * 20_000, None, "s", None),
            (3, "word " * 20_000, None, "s", None), (None, "the quick " * 40, "en", "s", 1),
            (5, "a\n" * 300, "en", "s", 600), (5, "other text of this id", "en", "s", 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema)
        for name in CLASHING:
            docs = docs.withColumn(name, docs["source"])
        for name, function in corpus_pipeline.STAGES:
            found = function(spark, docs, SF).collect()
            ids = [r.doc_id for r in found]
            if name == "exact_dedup":  # the repeated row goes, and null or empty
                assert len(ids) == len(rows) - 2 if some else not ids
            elif name == "near_dedup":
                assert set(ids) <= {r[0] for r in some} and bool(ids) == bool(some)
            elif name == "personal_data":
                assert rows_of_ids(ids) == rows_of_ids(r[0] for r in some)
            elif name == "pack":  # every document has its end at least
                assert set(ids) == {r[0] for r in some}
            else:
                assert set(ids) <= {None, 3, 5}  # the others have too few words
