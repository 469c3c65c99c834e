"""What a running stream reports: rule counts per batch, the end of a backlog, restarts."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import LongType, StructField, StructType

from strata.operators.quality import Rule, enforce
from strata.session import exists, write_text

CHECKED = "checked"
IDLE = "spark.sql.streaming.noDataProgressEventInterval"


class _Listener(StreamingQueryListener):
    """The calls a listener need not care about."""

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def counted(rows: DataFrame, rules: list[Rule], name: str) -> DataFrame:
    """enforce() on a stream, with the rows checked and those failing each rule counted as they
    pass. The counts of each batch reach the listeners under `name`."""
    counts = [F.count_if(~r.holds()).alias(r.name) for r in rules]
    return enforce(rows.observe(name, F.count(F.lit(1)).alias(CHECKED), *counts), rules)


class RuleCounts(_Listener):
    """Stores the counts of counted() below a path, a small file per batch. A batch that is
    repeated replaces its file, so it counts once, whichever run of the query it came from."""

    def __init__(self, spark: SparkSession, name: str, path: str) -> None:
        self.spark, self.name, self.path = spark, name, path.rstrip("/")
        self.seen: dict[str, int] = {}
        self.news = threading.Condition()

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = progress.observedMetrics.get(self.name)
        if found is not None and progress.numInputRows > 0:
            write_text(self.spark, f"{self.path}/batch-{progress.batchId}.json", json.dumps(
                {"batch_id": progress.batchId, **found.asDict()}))
        with self.news:
            self.seen[str(progress.id)] = progress.batchId
            self.news.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the last batch of a query that has ended has been reported."""
        last = query.lastProgress
        if last is not None:
            with self.news:
                self.news.wait_for(lambda: self.seen.get(str(query.id), -1) >= last["batchId"],
                                   seconds)

    def __enter__(self) -> RuleCounts:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        self.spark.streams.removeListener(self)


def rule_counts(spark: SparkSession, path: str, rules: list[Rule]) -> DataFrame:
    """One row per batch and rule stored by RuleCounts: batch_id, rule, action, checked, failed."""
    fields = ["batch_id", CHECKED, *[r.name for r in rules]]
    schema = StructType([StructField(f, LongType()) for f in fields])
    if not exists(spark, path):
        stored = spark.createDataFrame([], schema)
    else:
        stored = spark.read.schema(schema).json(path)
    each = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
                              F.col(CHECKED).alias("checked"), F.col(r.name).alias("failed"))
                     for r in rules])
    return stored.select("batch_id", F.inline(each))


class _Idle(_Listener):
    def __init__(self) -> None:
        self.idle, self.busy = threading.Event(), False

    def onQueryProgress(self, event) -> None:
        if event.progress.numInputRows > 0:
            self.busy = True
        elif self.busy:
            self.idle.set()

    def onQueryIdle(self, event) -> None:
        self.idle.set()


def until_idle(spark: SparkSession, start: Callable[[], StreamingQuery], seconds: float = 600,
               quiet: str = "1s") -> StreamingQuery:
    """Start a query that would keep running and stop it when a listener hears that it has had
    nothing to do for `quiet`. It is stopped between batches; a failure is raised."""
    watch, before = _Idle(), spark.conf.get(IDLE, None)
    spark.conf.set(IDLE, quiet)
    spark.streams.addListener(watch)
    try:
        query = start()
        waited = 0.0
        while query.isActive and not watch.idle.wait(0.2):
            waited += 0.2
            if waited > seconds:
                break
        if query.exception() is not None:
            raise query.exception()
        if query.isActive:
            query.processAllAvailable()
            query.stop()
        return query
    finally:
        spark.streams.removeListener(watch)
        if before is None:
            spark.conf.unset(IDLE)
        else:
            spark.conf.set(IDLE, before)


def restarted(start: Callable[[], StreamingQuery], tries: int = 3) -> StreamingQuery:
    """Run a query to its end, and again from its checkpoint if it fails, `tries` times in all.
    A batch that had begun is repeated as it was; the last failure is raised."""
    for left in range(tries - 1, -1, -1):
        query = start()
        try:
            query.awaitTermination()
            return query
        except StreamingQueryException:
            if not left:
                raise
    raise ValueError("tries must be positive")
