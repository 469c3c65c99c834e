"""Start streams, and sinks that survive a restart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.session import exists, remove


def trigger(continuous: bool, interval: str = "1 minute") -> dict[str, object]:
    """A stream that keeps running, or one that works off what is there and ends."""
    return {"processingTime": interval} if continuous else {"availableNow": True}


def to_files(df: DataFrame, path: str, checkpoint: str, continuous: bool = False,
             partition_by: list[str] | None = None) -> StreamingQuery:
    """Append a stream to parquet files. The file sink logs each batch, so a restart from the
    same checkpoint neither loses nor repeats rows."""
    writer = (
        df.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**trigger(continuous))
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()


def each_batch(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
               mode: str = "append", continuous: bool = False,
               interval: str = "1 minute") -> StreamingQuery:
    """Hand every micro-batch to write(batch, batch_id)."""
    return (
        df.writeStream.foreachBatch(write).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(**trigger(continuous, interval)).start()
    )


def batch_folders(path: str, encode: Callable[[DataFrame], DataFrame] | None = None
                  ) -> Callable[[DataFrame, int], None]:
    """A batch writer that gives each batch its own folder. A repeated batch replaces its
    folder, so a retry after a lost executor or driver adds nothing twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = encode(batch) if encode else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def _folders(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a pattern stands for, and none else listed."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [str(status.getPath()) for status in system.globStatus(place) or ()]


def _below(path: str) -> int:
    """The batch a folder batch_id=N belongs to."""
    return int(path.rsplit("=", 1)[1])


SPAN = 1 << 20  # offsets of a partition that one slot of the identity index holds


def _slot(keys: list[str], span: int) -> Column:
    """The slot of a message: a hash of its topic and partition, and the range of its offset. Its
    name has no character that a folder's name could not have."""
    *stream, offset = keys
    return F.concat_ws("-", F.hex(F.xxhash64(*stream)),
                       F.coalesce(F.floor(F.col(offset) / span).cast("string"), F.lit("none")))


def known_rows(spark: SparkSession, path: str, slots: list[str], batch_id: int,
               like: DataFrame) -> DataFrame:
    """The identities that batches before the given one have stored in these slots. Only the
    slots' folders are listed and read, however many batches and slots there are."""
    found = [f for slot in slots for f in _folders(spark, f"{path}/_identity/slot={slot}/batch_id=*")
             if _below(f) < batch_id]
    if not found:
        return spark.createDataFrame([], like.schema)
    return spark.read.schema(like.schema).parquet(*found)


def new_rows(path: str, keys: list[str], encode: Callable[[DataFrame], DataFrame],
             span: int = SPAN) -> Callable[[DataFrame, int], None]:
    """A batch writer that stores what encode() makes of the batch, without the rows whose key
    an earlier batch has stored. No state is kept and no row is too late: beside the rows lies an
    index of their keys, by slots of topic, partition and offset range, and a batch reads the
    slots that it touches. A batch that has been stored is left as it is, so readers never meet
    it twice; one that stopped before its keys were in the index has them entered again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, folder = batch.sparkSession, f"{path}/batch_id={batch_id}"
        if not exists(spark, f"{folder}/_SUCCESS"):
            batch.persist()
            try:
                rows = encode(batch)
                slots = [r[0] for r in rows.select(_slot(keys, span)).distinct().collect()]
                known = known_rows(spark, path, slots, batch_id, rows.select(*keys))
                rows.join(known, keys, "left_anti").select(*rows.columns).write.mode(
                    "overwrite").parquet(folder)
            finally:
                batch.unpersist()
        elif exists(spark, f"{path}/_identity/_done/{batch_id}"):
            return
        stored = spark.read.parquet(folder).select(
            *keys, _slot(keys, span).alias("slot"), F.lit(batch_id).alias("batch_id"))
        (stored.hint("rebalance", "slot").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("slot", "batch_id")
         .parquet(f"{path}/_identity"))
        _mark(spark, f"{path}/_identity/_done/{batch_id}")

    return write


def _mark(spark: SparkSession, path: str) -> None:
    """An empty file, there at once or not at all."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place, True).close()


def published(spark: SparkSession, path: str) -> int:
    """The last batch of a table of groups that its readers may see, -1 for none."""
    return max((int(f.rsplit("/", 1)[1]) for f in _folders(spark, f"{path}/_published/*")),
               default=-1)


DAY = "yyyyMMdd"


def merged_groups(path: str, at: str, encode: Callable[[DataFrame], DataFrame],
                  add: Callable[[DataFrame], DataFrame], period: str = DAY
                  ) -> Callable[[DataFrame, int], None]:
    """A batch writer for a table of groups, laid out by the period (a date pattern) of the column
    `at`: encode() sums up a batch, add() what the table has of the same periods with it, and
    these get a new version; no other period is listed, read or written. When the versions are
    whole the batch is published, and only then do readers (newest()) see them. Of a period the
    version before stays, for readers at work and for a batch that is repeated; older ones go."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if published(spark, path) >= batch_id:
            return
        slot = F.coalesce(F.date_format(at, period), F.lit("none"))
        rows = encode(batch).persist()
        try:
            touched = [r[0] for r in rows.select(slot).distinct().collect()]
            before = {x: sorted((_below(f), f) for f in _folders(
                spark, f"{path}/slot={x}/batch_id=*") if _below(f) < batch_id) for x in touched}
            known = [found[-1][1] for found in before.values() if found]
            if known:
                rows = rows.unionByName(spark.read.schema(rows.schema).parquet(*known))
            (add(rows).withColumns({"slot": slot, "batch_id": F.lit(batch_id)})
             .hint("rebalance", "slot").write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("slot", "batch_id")
             .parquet(path))
        finally:
            rows.unpersist()
        _mark(spark, f"{path}/_published/{batch_id}")
        for old in [f for found in before.values() for _, f in found[:-1]]:
            remove(spark, old)
        for mark in _folders(spark, f"{path}/_published/*"):
            if int(mark.rsplit("/", 1)[1]) < batch_id:
                remove(spark, mark)

    return write


def _versions(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Per period the folders of its published versions, oldest first."""
    last, periods = published(spark, path), {}
    for folder in sorted(_folders(spark, f"{path}/slot=*/batch_id=*"), key=_below):
        if _below(folder) <= last:
            periods.setdefault(folder.rsplit("/", 2)[1], []).append(folder)
    return periods


def compact(spark: SparkSession, path: str) -> None:
    """Remove the versions that merged_groups() has kept beside the current one of each period. No
    reader may be at work on an older state of the table, and no batch under way."""
    for found in _versions(spark, path).values():
        for old in found[:-1]:
            remove(spark, old)


def newest(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of a table kept by merged_groups(): of each period the last published
    version."""
    found = [folders[-1] for folders in _versions(spark, path).values()]
    return spark.read.parquet(*(found or [path]))
