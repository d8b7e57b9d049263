"""Session set-up and the shared scratch folder.

Everything written between two steps of a job goes below one root that all
executors can reach: the folder named by ``spark.checkpoint.dir``.  Only a local
session without that setting gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a session may be given at any time.
RUNTIME_CONF = {
    # Epoch <-> calendar conversions follow the session time zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Streaming state lives off-heap and on disk, not in the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A batch uploads its changes, not its whole state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_roots: dict[str, str] = {}


@contextmanager
def with_conf(spark: SparkSession, **settings) -> Iterator[None]:
    """Runtime settings for the length of a ``with`` block; ``__`` stands for a dot."""
    named = {key.replace("__", "."): str(value) for key, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in named}
    try:
        for key, value in named.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def is_local(spark: SparkSession) -> bool:
    """True if driver and executors are one process."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def build_session(app_name: str = "tidewell", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or get) a session with the settings the operators rely on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables of this application."""
    sc = spark.sparkContext
    if sc.applicationId in _roots:
        return _roots[sc.applicationId]
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if base is None:
        if not is_local(spark):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="tidewell-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    root = f"{base.rstrip('/')}/tidewell-{sc.applicationId}-{uuid.uuid4().hex[:8]}"
    # Scratch data is removed by the file system client when the driver ends.
    path = sc._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    _roots[sc.applicationId] = root
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared root."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with data that outlives any executor, and later passes read
    only the columns they need.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_listing(df: DataFrame, label: str, files_per_task: int = 1000) -> DataFrame:
    """``df``, which looks at files and not at their content, computed once and stored.

    Spark deals files to tasks by their bytes, which says nothing about such a scan: here
    the number of tasks follows the number of files, whatever their size.
    """
    tasks = 1 + len(df._jdf.inputFiles()) // files_per_task
    with with_conf(df.sparkSession, spark__sql__files__minPartitionNum=tasks,
                   spark__sql__files__maxPartitionBytes=(1 << 62),
                   spark__sql__files__openCostInBytes=0):
        return materialize(df, label)
