"""Session settings and shared folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings the jobs count on. Skewed shuffle-join partitions are split
# even when that costs one more shuffle, so that a hot order, customer, product
# or seller never stays in a single task. Where every shuffled partition of one side
# is below the threshold, adaptive execution hashes that side instead of sorting both;
# a side with a larger partition is sorted, as a hash table cannot spill. Shuffle files
# go once the query that wrote them has ended, not when the driver happens to collect its
# garbage; a frame that is run again shuffles again.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in JOB_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the session names.

    A temporary folder stands in only for a local session that names none; on a
    cluster the folder has to be shared, so a missing setting is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="merchlens-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def warehouse_folder(spark: SparkSession, purpose: str) -> str:
    """Path of a fresh folder below the session's warehouse, which executors share."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job wrote, in whatever store it is."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def new_shared_folder(spark: SparkSession, purpose: str) -> str:
    """Path of a fresh folder for written tables, below the checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
