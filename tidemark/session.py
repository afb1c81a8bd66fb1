"""Session settings and the shared folder for staged data."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tidemark import fs

# What a production session should carry. Nothing in the library changes these
# behind the caller's back; pass them to the builder or to spark-submit.
RECOMMENDED_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split hot join partitions even where the split costs another exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # size files and reduce tasks by bytes, not by the number of cores
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    # incoming keys up to this size spare the target its shuffle; the estimate
    # is of files on disk, so it is scaled to what rows take in memory
    "spark.sql.autoBroadcastJoinThreshold": "128m",
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.orc.filterPushdown": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.statistics.size.autoUpdate.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
}

_GIB = 1 << 30
_local_dirs: dict[str, tempfile.TemporaryDirectory] = {}


def shuffle_partitions(shuffled_bytes: int, task_bytes: int = _GIB // 2,
                       cores: int = 1, most: int = 100_000) -> int:
    """``spark.sql.shuffle.partitions`` for a load that shuffles that many bytes.

    Enough for a partition to sort in memory, at least one per core; adaptive
    execution joins the ones that turn out small.
    """
    return max(cores, min(most, -(-shuffled_bytes // task_bytes)))


def local_session(app: str, cpus: int = 8, memory: str = "8g",
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A single-process session for tests and the bench."""
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local-mode session without that setting gets a temporary folder that
    goes away with the process. A cluster session without it is an error:
    a folder on one machine would be invisible to the others.
    """
    named = (spark.conf.get("spark.checkpoint.dir", None)
             or spark.sparkContext.getConf().get("spark.checkpoint.dir", None))
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.TemporaryDirectory(prefix="tidemark-")
    return _local_dirs[app].name


_made: dict[str, list[str]] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below :func:`work_dir`; nothing exists there yet.

    It stays until :func:`release`, since results may still be read from it.
    """
    path = os.path.join(work_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Remove every scratch path this session made; returns how many there were."""
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        fs.remove(spark, path)
    return len(paths)


@contextmanager
def staging(spark: SparkSession, name: str) -> Iterator[str]:
    """A scratch path for one step, removed when the step is over."""
    path = scratch(spark, name)
    try:
        yield path
    finally:
        fs.remove(spark, path)
        made = _made.get(spark.sparkContext.applicationId, [])
        if path in made:
            made.remove(path)
