"""Session settings and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Keeps the state of a stream on disk, not on the heap.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def get_session(master: str = "local[8]", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster the submitter sets these."""
    builder = (
        SparkSession.builder.master(master)
        .appName("starling")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster.

    Only a local master may fall back to a folder of this machine: there the driver
    and the executors are one process.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="starling-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a working table; never reused, so nothing is overwritten."""
    return f"{shared_dir(spark).rstrip('/')}/starling/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet to the shared folder and go on from the table.

    For results that several steps read, and for join sides: a scan lets AQE split the
    partition of a hot key, which it cannot below an aggregate.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def durable(df: DataFrame) -> DataFrame:
    """Write `df` to the reliable checkpoint folder and continue from there.

    Used where a later step must see exactly the rows and partition numbers of an
    earlier one, and where an iteration would otherwise grow its lineage.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
