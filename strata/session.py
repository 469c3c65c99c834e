"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every job relies on. They may be set on a running session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the split costs one more exchange above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Keep streaming state off the executor heap; the number of groups is not bounded by us.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

MB = 1024 * 1024
# A shuffle has one block per map task and partition, so neither number may grow without end:
# beyond these, tasks get larger instead, and spill.
PARTITION_BYTES, MOST_PARTITIONS = 256 * MB, 40_000
PARTITIONS = "spark.sql.shuffle.partitions"
MERGED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
TASK_BYTES = 512 * MB  # a scan or merged partition of expanding tables, as rows in memory
SPLIT_BYTES, LARGEST_SPLIT, MOST_SPLITS = 128 * MB, 1024 * MB, 100_000

_local_scratch: str | None = None
# Of the sized settings, what the session was given and what it was last set to.
_given: dict[str, tuple[str, str]] = {}


def configure(spark: SparkSession, input_bytes: int = 0, expanded: int = 1) -> SparkSession:
    """Apply SETTINGS, and size scans and shuffles for one job's input: the larger of what the
    session was given and what the input asks for. A later job sizes them anew, so nothing of a
    large one stays. Adaptive execution merges partitions that turn out small. Tasks sort rows,
    not files: `expanded` says how many times the stored bytes rows take in memory. Shuffles are
    sized by that, and scans are split and partitions merged to match."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    chosen, rows = {}, sizing(input_bytes * expanded)
    for key, wanted in sizing(input_bytes).items():
        given = _session_value(spark, key)
        if key == PARTITIONS:
            wanted = rows[key]
        elif expanded > 1 and input_bytes:
            least = min(math.ceil(input_bytes / MOST_SPLITS), LARGEST_SPLIT)
            chosen[key] = str(max(min(_bytes(given), TASK_BYTES // expanded), least))
            continue
        chosen[key] = str(wanted) if _bytes(given) < wanted else given
    given = _session_value(spark, MERGED)
    chosen[MERGED] = str(min(_bytes(given), TASK_BYTES // (2 * expanded))) if expanded > 1 else given
    for key, value in chosen.items():
        _given[key] = (_session_value(spark, key), value)
        spark.conf.set(key, value)
    return spark


def _session_value(spark: SparkSession, key: str) -> str:
    """What the session was given, or what its user has set since."""
    now, known = spark.conf.get(key), _given.get(key)
    return known[0] if known and now in known else now


def sizing(input_bytes: int) -> dict[str, int]:
    """Shuffle partitions and scan split size for an input of the given size."""
    partitions = min(math.ceil(input_bytes / PARTITION_BYTES), MOST_PARTITIONS)
    split = min(max(SPLIT_BYTES, math.ceil(input_bytes / MOST_SPLITS)), LARGEST_SPLIT)
    return {PARTITIONS: partitions,
            "spark.sql.files.maxPartitionBytes": split if input_bytes else 0}


def _bytes(text: str) -> int:
    """A plain number, or one with a size suffix as Spark writes them (128m, 1g, 134217728b)."""
    text = text.strip().lower().removesuffix("b")
    scale = {"k": 1024, "m": MB, "g": 1024 * MB, "t": MB * MB}.get(text[-1:], 1)
    return int(text.rstrip("kmgt")) * scale


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes stored below a path, as its file system reports them."""
    place, system = _place(spark, path)
    return system.getContentSummary(place).getLength()


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return system.exists(place)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file, such as a batch's report, by the text."""
    place, system = _place(spark, path)
    out = system.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has written."""
    place, system = _place(spark, path)
    system.delete(place, True)


def local_session(cpus: int | str = "*", app: str = "strata", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else str(cpus))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and checkpoints.

    A cluster names it in spark.checkpoint.dir. Only a local session without that setting
    gets a folder of its own."""
    global _local_scratch
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="strata-")
    return _local_scratch


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing exists there yet."""
    return f"{scratch_root(spark)}/strata/{label}-{uuid.uuid4().hex}"
