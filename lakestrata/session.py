"""Session construction and shared-storage helpers.

Everything that must survive an executor loss (stream checkpoints, staging
copies for rewrites, cut lineage) lives under the folder the cluster names in
``spark.checkpoint.dir``.  Only on a local master (tests) a private
folder is created when that setting is absent; on a cluster it must be set.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings every job of the library expects.  AQE coalesces small shuffles,
# splits skewed join partitions and turns joins with a measured-small side
# into broadcast joins at run time.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # runtime (measured) size under which AQE turns a shuffle join into a broadcast
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # AQE coalesces shuffle partitions towards this size; set
    # spark.sql.shuffle.partitions high on a cluster and let AQE shrink it
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # remove reliable-checkpoint files once their RDD is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app: str = "lakestrata",
                  shuffle_partitions: int | None = None,
                  time_zone: str = "UTC", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.session.timeZone"] = time_zone
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staging.

    Read from the session; a private temp folder is set only when the
    cluster did not name one (local runs and tests).
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="lakestrata-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df):
    """Reliable checkpoint into the shared folder (never localCheckpoint)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


_HELD: dict = {}
_LOCK = threading.Lock()


@contextmanager
def session_conf(spark: SparkSession, key: str, value: str):
    """A setting of the session for the time of a block.

    Blocks of several threads may overlap: the last one that is left restores what was set before the first."""
    held, mine = (spark._jsparkSession.sessionUUID(), key), (value,)
    with _LOCK:
        before, blocks = _HELD.setdefault(held, (spark.conf.get(key, None), []))
        blocks.append(mine)
        spark.conf.set(key, value)
    try:
        yield
    finally:
        with _LOCK:
            del blocks[next(i for i, b in enumerate(blocks) if b is mine)]
            after = blocks[-1][0] if blocks else before
            spark.conf.unset(key) if after is None else spark.conf.set(key, after)
            if not blocks:
                del _HELD[held]


def shuffles_dropped(spark: SparkSession):
    """Writes in the block remove their shuffle files when they end.  Else these lie on the executors' disks until the
    driver happens to collect garbage, so that a job of many writes holds the shuffles of all of them at once."""
    return session_conf(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def write_staged(df, name: str):
    """Write ``df`` to the shared folder and return the written table, whose size the planner knows."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
