"""SparkSession defaults shared by jobs, tests and the bench.

Everything here is a plain Spark config. The session time zone is pinned to
UTC so that epoch windows, day boundaries and rendered dates do not depend on
the machine. The checkpoint directory is read from ``spark.checkpoint.dir``;
when it is unset, a local master (tests) gets a scratch folder and any other
master an error.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def builder(master: str | None = None, app_name: str = "rivulet", shuffle_partitions: int | None = None,
            driver_memory: str | None = None):
    b = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # keyed state for transformWithState lives in RocksDB; Python state
        # traffic goes through a socket file rather than a TCP port
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .config("spark.python.unix.domain.socket.enabled", "true")
    )
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:  # local mode: the driver JVM is the whole cluster
        b = b.config("spark.driver.memory", driver_memory)
    return b


def get_session(master: str | None = None, app_name: str = "rivulet", shuffle_partitions: int | None = None,
                driver_memory: str | None = None) -> SparkSession:
    spark = builder(master, app_name, shuffle_partitions, driver_memory).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever the deployment put in
    ``spark.checkpoint.dir`` (a shared file system). When it is unset, a
    scratch folder is created under a local master only: on a cluster the
    executors would not share it, so that raises.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        path = tempfile.mkdtemp(prefix="rivulet-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")


def materialize(df, name: str):
    """``df`` written as a table in the shared folder and read back: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed_state(spark: SparkSession) -> None:
    """Keyed state of ``transformWithState`` needs the RocksDB state store; sessions of other makers may lack it."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """Checkpoint location of a named streaming query under the shared folder."""
    return os.path.join(checkpoint_dir(spark), "streams", name)


def size_shuffle_partitions(spark: SparkSession, paths, target_bytes: int = 256 << 20) -> int:
    """Size ``spark.sql.shuffle.partitions`` from the input bytes (one partition per ``target_bytes``).

    At 100 TB the default 200 partitions would be ~500 GB each and spill;
    this gives ~400k at 256 MB, and never fewer than the task slots. AQE then
    coalesces partitions that turn out small (filters, partial aggregation),
    so the number is an upper bound, not a fixed cost.
    """
    n = max(spark.sparkContext.defaultParallelism, -(-input_bytes(spark, paths) // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


def raise_shuffle_partitions(spark: SparkSession, paths, target_bytes: int = 256 << 20) -> int:
    """The same for a session whose number someone else chose: raises it where the input needs more, never lowers it."""
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    need = -(-input_bytes(spark, paths) // target_bytes)
    if need > now:
        spark.conf.set("spark.sql.shuffle.partitions", str(need))
    return max(now, need)


def input_bytes(spark: SparkSession, paths) -> int:
    """Bytes under the paths, on any file system Spark reads."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem API for sizes
    hconf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    total = 0
    for p in ([paths] if isinstance(paths, str) else paths):
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(hconf).getContentSummary(path).getLength()
    return total
