"""Session settings and the shared working folder.

Settings follow the build plan: ANSI on (Spark 4 default), UTC session time
zone, AQE with partition coalescing and skew-join splitting. Shuffle
partitions are left to the cluster's configuration; tests pass a small number.
"""

from __future__ import annotations

import atexit
import math
import os
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tradelake", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # partitioned Parquet is the lake format; prune on (year, direction)
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # checkpointed intermediates are removed once nothing references them
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_settings(input_bytes: int, partition_bytes: int = 256 << 20) -> dict:
    """Shuffle and scan sizing for a job reading about ``input_bytes``.

    The shuffle partition count is an upper bound sized so that a full
    shuffle of the input (the lake write, a join back on raw facts) keeps
    partitions near ``partition_bytes``; adaptive execution coalesces the
    small partitions of the aggregates and splits skewed ones. The count
    follows the input at every size; ``partition_bytes`` is the parameter.
    """
    n = max(1, math.ceil(input_bytes / partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. Only a local session
    may leave it unset; a folder under the warehouse directory serves then.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext
        pass
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        if sc is None or not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        wh = spark.conf.get("spark.sql.warehouse.dir")
        d = wh.rstrip("/") + "/_tradelake_checkpoints"
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, removed when the process ends."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    if not _SCRATCH:
        atexit.register(remove_scratch)
    _SCRATCH.append((spark, path))
    return path


_SCRATCH: list[tuple[SparkSession, str]] = []


def remove_scratch() -> None:
    """Delete the scratch paths given out by this process; write results elsewhere first."""
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        try:
            delete_path(spark, path)
        except Exception:  # the session has ended: nothing left to ask
            return


def scratch_mark() -> int:
    """How many scratch paths this process holds; see ``release_scratch``."""
    return len(_SCRATCH)


def release_scratch(since: int) -> None:
    """Delete the scratch paths given out after a mark: intermediates of a result that is written elsewhere."""
    while len(_SCRATCH) > since:
        spark, path = _SCRATCH.pop()
        delete_path(spark, path)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of a path or pattern; for names and small control files only."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of this library's own making."""
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def materialize(df, name: str = "table", compression: str = "snappy"):
    """Write an intermediate that is read more than once as Parquet in the shared folder.

    Later uses scan the copy with column pruning, pushdown and known size,
    and it survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
