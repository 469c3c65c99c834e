"""Every registered query against its SQL twin, with two layouts of the work."""

import math

import pytest

import __spark_entry__ as contract
import check_queries
from strata import session
from workloads import oracle, queries
from workloads.queries import QUERIES

from support import SF

STREAMS = [n for n in QUERIES if n.endswith("_stream")]


@pytest.fixture(scope="module")
def con():
    return check_queries.database(SF)


def test_every_query_has_a_twin():
    assert sorted(QUERIES) == sorted(oracle.SQL)
    assert set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert check_queries.compare(spark, con, SF, name) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STREAMS])
def test_result_does_not_depend_on_the_layout(spark, con, name, monkeypatch):
    changed = {"spark.sql.shuffle.partitions": "13", "spark.sql.files.maxPartitionBytes": "16KB",
               "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in changed}
    settings = dict(session.SETTINGS)
    session.SETTINGS.pop("spark.sql.adaptive.enabled")
    monkeypatch.setattr(session, "sizing", lambda size: {})
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        assert check_queries.compare(spark, con, SF, name) is None
    finally:
        session.SETTINGS.update(settings)
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["client_silver_backlog", "client_gold_hourly_compacted"])
def test_a_backlog_has_more_files_as_messages_grow(spark, con, name, monkeypatch):
    found, events = [], spark.read.parquet(f"{SF}/events.parquet").count()

    def stream(t, path, files):
        for n in range(3):
            found.append(len(spark.read.parquet(f"{path}/delivery={n}").inputFiles()))
        return read(t, path, files)

    read = queries._backlog_stream
    monkeypatch.setattr(queries, "_backlog_stream", stream)
    monkeypatch.setattr(queries, "MESSAGE_BYTES", 2 << 20)
    assert check_queries.compare(spark, con, SF, name) is None
    assert found == [math.ceil(events * (2 << 20) / session.PARTITION_BYTES)] * 3
    assert found[0] > 4
