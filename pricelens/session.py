"""Session defaults and the shared scratch location.

Nothing here creates a session at import time.  ``build_session`` is for
scripts, tests and the bench; library operators take the caller's session.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators are written against.  AQE re-plans joins (runtime
# broadcast of sides that turn out small, skew-join splitting of hot keys)
# and coalesces small shuffle partitions; the session zone is pinned so
# weekday/hour never depend on the machine.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join whose output is aggregated on the same key is split, too, at the
    # price of one shuffle of partial results.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "pricelens",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SCALE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared filesystem folder and is used
    as is.  Only when it is unset (local tests) a folder is created here.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="pricelens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/pricelens/{name}-{uuid.uuid4().hex[:12]}"


def sized_conf(shuffle_bytes: int, total_cores: int,
               target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Partition settings for a job that shuffles about ``shuffle_bytes``.

    The shuffle partition count is an upper bound (AQE coalesces small
    stages down to ``advisoryPartitionSizeInBytes``): enough partitions of
    ``target_partition_bytes`` each for the largest shuffle, and at least
    three waves of tasks over the cluster's cores so stragglers and lost
    executors cost little.  File splits use the same target size.
    """
    parts = max(3 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }
