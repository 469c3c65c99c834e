import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata import schemas
from strata.plans import messages
from strata.sinks.lake import Lake
from strata.sources import files, kafka, synthetic
from strata.streaming import messages as streams
from strata.streaming import runner

from support import rows


@pytest.fixture
def feed(spark, path):
    """A folder of raw messages that tests add files to."""
    offset = iter(range(10 ** 6))

    class Feed:
        folder = path("feed")

        def add(self, *times, amount=1.0, offsets=None, sent=datetime(2024, 1, 1), **fields):
            data = []
            for i, t in enumerate(times):
                text = json.dumps({"client_id": "c1", "client_name": "C", "timestamp": t,
                                   "event_type": "login", "amount": amount,
                                   "status": "active", **fields})
                at = offsets[i] if offsets else next(offset)
                data.append(("c1", text, "t", 0, at, sent))
            (spark.createDataFrame(data, schemas.RAW_MESSAGE).coalesce(1)
             .write.mode("append").parquet(self.folder))

        def stream(self):
            return files.stream_files(spark, self.folder, schemas.RAW_MESSAGE)

        def one_by_one(self):
            rows_ = spark.readStream.schema(schemas.RAW_MESSAGE).option("maxFilesPerTrigger", 1)
            return messages.accepted(messages.ingest(rows_.parquet(self.folder)))

        def bronze(self):
            return messages.accepted(messages.ingest(self.stream()))

    return Feed()


def run(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def test_trigger_kinds():
    assert runner.trigger(False) == {"availableNow": True}
    assert runner.trigger(True, "5 seconds") == {"processingTime": "5 seconds"}


def test_restart_adds_only_what_is_new(spark, feed, path):
    def go():
        run(streams.bronze(feed.stream(), path("bronze"), path("log")))
        return spark.read.parquet(path("bronze")).count()

    feed.add("2024-01-01T10:00:00Z", "2024-01-01T10:05:00Z")
    assert go() == 2 and go() == 2
    feed.add("2024-01-01T10:10:00Z")
    assert go() == 3


def test_silver_knows_repeats_across_batches(spark, feed, path):
    def go():
        run(streams.silver(feed.bronze(), path("silver"), path("log")))
        return rows(spark.read.parquet(path("silver")).select("kafka_offset"))

    feed.add("2024-01-01T10:00:00Z", "2024-01-01T10:01:00Z", offsets=[1, 2])
    assert go() == [(1,), (2,)]
    feed.add("2024-01-01T10:00:30Z", "2024-01-01T10:02:00Z", offsets=[2, 3])
    assert go() == [(1,), (2,), (3,)]
    feed.add("2020-01-01T10:00:00Z", offsets=[4])  # an old event, newly delivered
    assert go() == [(1,), (2,), (3,), (4,)]


def test_silver_loses_no_lagging_partition(spark, feed, path):
    """Three files, one per batch, each a month or days behind the one before."""
    for n, day in enumerate((30, 28, 1)):
        feed.add(*[f"2024-01-{day:02}T10:{m:02}:00Z" for m in range(10)],
                 offsets=list(range(n * 10, n * 10 + 10)), sent=datetime(2024, 1, day))
    feed.add("2024-01-30T10:00:00Z", offsets=[3], sent=datetime(2024, 1, 30))
    run(streams.silver(feed.one_by_one(), path("silver"), path("log")))
    stored = spark.read.parquet(path("silver"))
    assert rows(stored.select("kafka_offset"), "kafka_offset") == [(n,) for n in range(30)]
    assert rows(streams.late_arrivals(spark, path("silver")))[:3] == [(0, 10, 0), (1, 10, 10),
                                                                      (2, 10, 10)]


def test_a_stored_batch_is_not_stored_again(spark, feed, path):
    feed.add("2024-01-01T10:00:00Z", offsets=[1])
    write = runner.new_rows(path("out"), messages.MESSAGE_ID, messages.silver)
    batch = messages.accepted(messages.ingest(
        spark.read.schema(schemas.RAW_MESSAGE).parquet(feed.folder)))
    write(batch, 0)
    before = spark.read.parquet(path("out")).inputFiles()
    write(batch, 0)
    write(batch, 1)
    stored = spark.read.parquet(path("out"))
    assert stored.count() == 1 and set(before) <= set(stored.inputFiles())


def test_a_dominant_client_has_several_writers(spark, path):
    data = spark.range(200_000).selectExpr(
        "if(id % 10 = 0, concat('c', id % 7), 'hot') AS client_id", "id", "uuid() AS pad")
    settings = {"spark.sql.shuffle.partitions": "64",
                "spark.sql.files.maxPartitionBytes": "512k",
                "spark.sql.files.openCostInBytes": "512k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512k"}
    before = {k: spark.conf.get(k) for k in settings}
    data.repartition(16).write.parquet(path("in"))
    plain = messages.accepted
    messages.accepted = lambda rows_: rows_
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        run(streams.client_layers(spark.readStream.schema(data.schema).parquet(path("in")),
                                  path("out"), path("log")))
    finally:
        messages.accepted = plain
        for k, v in before.items():
            spark.conf.set(k, v)
    stored = spark.read.parquet(path("out"))
    files_of = lambda c: len({f for f in stored.inputFiles() if f"client_id={c}/" in f})
    assert stored.count() == 200_000 and files_of("hot") > 8 and files_of("c0") <= 2


def hours(df):
    return rows(df.select(F.hour("window_start").alias("h"), "event_count", "total_amount"))


def test_hourly_table_is_current_and_equals_the_batch_twin(spark, feed, path):
    def go():
        rows_ = messages.enriched(feed.bronze())
        run(streams.hourly(rows_, path("hourly"), path("log")))
        return streams.hourly_table(spark, path("hourly"))

    feed.add("2024-01-01T10:00:00Z", "2024-01-01T12:05:00Z")
    assert hours(go()) == [(10, 1, 1.0), (12, 1, 1.0)]
    feed.add("2024-01-01T10:30:00Z", amount=5.0)  # nothing is late
    got = go()
    assert hours(got) == [(10, 2, 6.0), (12, 1, 1.0)]
    batch = messages.hourly(messages.enriched(messages.accepted(messages.ingest(
        spark.read.schema(schemas.RAW_MESSAGE).parquet(feed.folder)))))
    assert rows(got) == rows(batch.drop("gold_processed_timestamp"))


def test_compaction_keeps_the_table(spark, feed, path):
    def go():
        rows_ = messages.enriched(feed.bronze())
        run(streams.hourly(rows_, path("hourly"), path("log")))
        return rows(streams.hourly_table(spark, path("hourly")))

    for day in (5, 1, 3):  # late events and a client without a name
        feed.add(f"2024-01-0{day}T10:00:00Z", "2024-01-01T10:30:00Z", amount=day + 0.1)
        feed.add("2024-01-01T10:30:00Z", client_name=None)
        go()
    before = go()
    for _ in range(2):
        streams.compact_hourly(spark, path("hourly"))
        assert rows(streams.hourly_table(spark, path("hourly"))) == before
    versions = spark.read.parquet(path("hourly")).select("slot", "batch_id").distinct()
    assert versions.count() == versions.select("slot").distinct().count() == 3
    feed.add("2024-01-01T10:40:00Z", "2024-01-05T10:40:00Z")
    after = go()
    assert sum(r[6] for r in after) == sum(r[6] for r in before) + 2
    batch = messages.hourly(messages.enriched(messages.accepted(messages.ingest(
        spark.read.schema(schemas.RAW_MESSAGE).parquet(feed.folder)))))
    assert after == rows(batch.drop("gold_processed_timestamp"))


def test_a_batch_reads_the_slots_it_touches(spark, path, monkeypatch):
    """Fifty batches of ten offsets, slots of ten: the files read do not grow with the batches."""
    keys, seen = ["topic", "part", "at"], []
    plain = runner.known_rows

    def looked(*args):
        found = plain(*args)
        seen.append(len(found.inputFiles()))
        return found

    monkeypatch.setattr(runner, "known_rows", looked)
    write = runner.new_rows(path("out"), keys, lambda rows_: rows_, span=10)
    batch = lambda low: spark.range(low, low + 10).selectExpr("'a/b=c' topic", "1 part", "id at")
    for n in range(50):
        write(batch(10 * n), n)
    assert max(seen) == 0
    write(batch(95).unionByName(spark.range(500, 501).selectExpr("'a/b=c' topic", "1 part", "id at")),
          50)
    assert 0 < seen[-1] <= 2 * 4
    stored = spark.read.parquet(path("out"))
    assert sorted(r.at for r in stored.collect()) == list(range(501))


def test_a_batch_that_stopped_before_its_index_is_entered(spark, path, monkeypatch):
    """The rows were stored, the index was not: the batch that is repeated enters it, and the
    next one knows the repeats."""
    write = runner.new_rows(path("out"), ["topic", "part", "at"], lambda rows_: rows_)
    batch = spark.range(3).selectExpr("'t' topic", "0 part", "id at")

    def broken(*_):
        raise OSError("lost")

    plain = runner._mark
    monkeypatch.setattr(runner, "_mark", broken)
    with pytest.raises(OSError):
        write(batch, 0)
    monkeypatch.setattr(runner, "_mark", plain)
    files_before = spark.read.parquet(path("out")).inputFiles()
    write(batch, 0)
    write(batch.unionByName(spark.range(9, 10).selectExpr("'t' topic", "0 part", "id at")), 1)
    stored = spark.read.parquet(path("out"))
    assert set(files_before) <= set(stored.inputFiles())
    assert sorted(r.at for r in stored.collect()) == [0, 1, 2, 9]


def test_only_touched_hours_are_written_and_seen_when_whole(spark, path, monkeypatch):
    add = lambda rows_: rows_.groupBy("k", "at").agg(F.sum("n").alias("n"))
    write = runner.merged_groups(path("out"), "at", add, add, period="yyyyMMddHH")
    batch = lambda *hours_: spark.createDataFrame(
        [("k", datetime(2024, 1, 1, h), 1) for h in hours_], "k string, at timestamp, n long")
    for n in range(12):
        write(batch(n % 3, 3 + n), n)
    at = lambda: sorted((r["at"].hour, r["n"]) for r in runner.newest(spark, path("out")).collect())
    whole = at()
    assert sum(n for _, n in whole) == 24 and (0, 4) in whole
    folders = runner._folders(spark, path("out") + "/slot=*/batch_id=*")
    assert len([f for f in folders if "slot=2024010100" in f]) == 2  # and none older

    plain = runner._mark
    monkeypatch.setattr(runner, "_mark", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        write(batch(0, 1), 12)
    assert at() == whole  # written, not published
    monkeypatch.setattr(runner, "_mark", plain)
    write(batch(0, 1), 12)
    write(batch(0, 1), 12)
    assert dict(at())[0] == dict(whole)[0] + 1 and sum(n for _, n in at()) == 26


def test_repeated_batch_replaces_its_folder(spark, path):
    write = runner.batch_folders(path("out"))
    for _ in range(2):
        write(spark.range(3), 7)
    assert spark.read.parquet(path("out")).count() == 3


def test_closed_hours_and_late_rows(spark, feed, path):
    def go():
        rows_ = messages.enriched(feed.bronze())
        return run(streams.hourly_closed(rows_, path("closed"), path("log")))

    feed.add("2024-01-01T10:00:00Z", "2024-01-01T12:30:00Z")
    assert streams.late_rows(go()) == 0
    assert hours(spark.read.parquet(path("closed"))) == [(10, 1, 1.0)]
    feed.add("2024-01-01T10:30:00Z", "2024-01-01T12:40:00Z", "2024-01-01T15:00:00Z")
    assert streams.late_rows(go()) == 1
    assert hours(spark.read.parquet(path("closed"))) == [(10, 1, 1.0), (12, 2, 2.0)]


def test_registry_lists_a_client_once(spark, feed, path):
    def go():
        run(streams.clients(feed.bronze(), path("clients"), path("log")))
        return rows(spark.read.parquet(path("clients")).select("client_id"))

    feed.add("2024-01-01T10:00:00Z", "2024-01-01T11:00:00Z")
    assert go() == [("c1",)]
    feed.add("2024-01-01T10:00:00Z")
    feed.add("2024-01-01T10:00:00Z", client_id="c2")
    assert go() == [("c1",), ("c2",)]


def test_layers_per_client_and_quarantine(spark, feed, path):
    feed.add("2024-01-01T10:00:00Z", "nope")
    feed.add("2024-01-01T10:00:00Z", client_id="c2")
    run(streams.client_layers(messages.ingest(feed.stream()), path("layers"), path("log1")))
    assert rows(spark.read.parquet(path("layers") + "/client_id=c2").select("amount")) == [(1.0,)]
    run(streams.quarantine(feed.stream(), path("bad"), path("log2"), "dlq"))
    bad = spark.read.parquet(path("bad"))
    assert bad.count() == 1 and "nope" in bad.first().raw_value


def test_rate_source_feeds_generated_messages(spark, path):
    """The generator: rate ticks become encoded messages, batch by batch."""
    def encode(batch):
        ids = batch.select(F.col("value").alias("id"))
        return kafka.encode(synthetic.messages(ids, "2024-01-01 00:00:00"))

    ticks = files.rate_stream(spark, 50)
    query = runner.each_batch(ticks, runner.batch_folders(path("sent"), encode), path("log"),
                              continuous=True, interval="1 second")
    try:
        for _ in range(30):
            query.awaitTermination(1)
            if sum(p.numInputRows for p in query.recentProgress) > 0:
                break
    finally:
        query.stop()
    sent = spark.read.parquet(path("sent"))
    assert sent.count() > 0 and sent.columns[:2] == ["key", "value"]


def test_table_as_stream(spark, path):
    spark.range(5).write.mode("overwrite").saveAsTable("ticks")
    run(runner.to_files(files.stream_table(spark, "ticks"), path("out"), path("log")))
    assert spark.read.parquet(path("out")).count() == 5


def test_all_layers_twice(spark, feed, path):
    lake = Lake(spark, path("lake"))
    feed.add("2024-01-01T10:00:00Z", "2024-01-01T11:00:00Z", "nope")
    assert hours(streams.run_available(lake, feed.stream(), "dlq")) == [(10, 1, 1.0), (11, 1, 1.0)]
    feed.add("2024-01-01T11:30:00Z")  # late by event time, kept
    assert hours(streams.run_available(lake, feed.stream(), "dlq")) == [(10, 1, 1.0), (11, 2, 2.0)]
    assert lake.read("bronze", "quarantine").count() == 1
    assert lake.read("bronze", "clients").count() == 1
    assert lake.read("silver", "by_client").count() == 3
