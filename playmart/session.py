"""Session construction and the shared scratch folder.

Jobs never assume a machine-local temp folder: scratch data (staged landing
files, loaded star tables, stream checkpoints) lives under the folder the
cluster names in ``spark.checkpoint.dir``.  Only when that setting is absent
(local tests) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings chosen for the production shape of the jobs.  Shuffle width is left
# to AQE (coalescing + skew-join split); the broadcast threshold is Spark's own
# size check, applied statically from file stats and again at runtime by AQE.
# Parquet sizes are compressed sizes; the compression factor scales them up so
# the static check does not broadcast a table that is several times larger in
# memory than on disk.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    # reports checkpoint small intermediates into the shared folder; remove
    # those files once nothing refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "playmart") -> SparkSession:
    """Session for tests and the local bench (``local[cores]``)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(total_cores: int) -> dict:
    """Settings for a cluster with ``total_cores`` executor cores.

    The initial shuffle width is generous (three tasks per core) so each
    partition of a large shuffle fits in memory; AQE then coalesces small
    partitions towards the advisory size and splits skewed ones.  Stateful
    streams freeze their width at first start, so they use the same number.
    """
    width = max(200, 3 * int(total_cores))
    conf = dict(DEFAULT_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        # larger AQE target partitions: fewer, bigger output files at scale
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    })
    return conf


def apply_job_conf(spark: SparkSession) -> None:
    """Pin the runtime SQL settings the library relies on (UTC, AQE)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled"):
        spark.conf.set(k, DEFAULT_CONF[k])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    # Unset: only tests and local runs may use a folder of this machine.
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="playmart-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


@contextmanager
def shuffle_width(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    """The shuffle width that queries started inside take with them; the session's own stays as it is.

    Stateful operators freeze their partition count in the checkpoint, and a streaming query copies the
    session's settings when it starts.
    """
    if not partitions:
        yield
        return
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@contextmanager
def open_files(spark: SparkSession, most: int) -> Iterator[None]:
    """Writes into folders by value: a task holds up to so many files open instead of sorting its rows by folder.

    With more values than that in one task the rest is sorted, as it is without this.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go when it ends, not when the driver happens to collect garbage.

    Streaming queries copy the session's settings when they start, so it holds for their batches too.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder beneath the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/playmart/{name}-{uuid.uuid4().hex[:12]}"


def drop_checkpoint(frame: DataFrame) -> None:
    """Delete the files of a frame that ``checkpoint()`` returned; neither it nor what is made of it is read again."""
    held = frame._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if held.isDefined():
        jvm, sc = frame.sparkSession.sparkContext._jvm, frame.sparkSession.sparkContext._jsc
        path = jvm.org.apache.hadoop.fs.Path(held.get())
        path.getFileSystem(sc.hadoopConfiguration()).delete(path, True)


def to_local_path(path: str) -> str:
    """Strip a ``file:`` scheme (used only by local helpers such as tests)."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return os.path.normpath(path)
