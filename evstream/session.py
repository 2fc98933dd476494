"""Session settings the library relies on, and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile
import uuid

import evstream
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Python functions of this package travel to the executors by value, so that only the driver
# needs it installed.
cloudpickle.register_pickle_by_value(evstream)

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Rows one task may be handed for one key before the key is cut into slices.
SLICE_ROWS = "evstream.slice.rows"
SLICE_ROWS_DEFAULT = 16_000_000
# Inputs whose planned size is below this many bytes cannot hold a key worth slicing.
SLICE_FLOOR = "evstream.slice.floor.bytes"
SLICE_FLOOR_DEFAULT = 64 * 1024 * 1024
# Bytes of a counted table of fixed-width rows that may be broadcast.
BROADCAST_BYTES = "evstream.broadcast.bytes"
BROADCAST_BYTES_DEFAULT = 64 * 1024 * 1024


def prepare(spark: SparkSession) -> SparkSession:
    """Set the run-time options every job expects, whoever built the session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Ranks are cut to the first n per task before the shuffle, however large n is: the cut
    # passes rows through one by one and holds none.
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", str(2**31 - 1))
    return spark


def prepare_streaming(spark: SparkSession) -> SparkSession:
    """As :func:`prepare`, plus the state store for keyed state that outgrows memory."""
    prepare(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
    )
    return spark


def local_session(cpus: str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("evstream")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.python.unix.domain.socket.enabled", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


def int_setting(spark: SparkSession, name: str, default: int) -> int:
    return int(spark.conf.get(name, str(default)))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="evstream-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for one run's checkpoint or result."""
    return f"{checkpoint_dir(spark).rstrip('/')}/evstream/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write a small derived table out so that every later reader sees the same rows."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def planned_bytes(df: DataFrame) -> int:
    """The optimiser's estimate of a table's size: compressed files scaled by the columns read. No
    bound: packed columns and exploded rows can be larger."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
