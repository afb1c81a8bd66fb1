"""What the operators of this subpackage share: staged tables, Arrow batches, text as bytes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside go as soon as each job is done."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends there.

    The files outlive a lost executor, and the shuffles that made them are
    freed at once.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    with freed_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(column: str = "text") -> F.Column:
    """Text as UTF-8 bytes; null becomes empty."""
    return F.coalesce(F.col(column).cast("string").cast("binary"), F.lit(b""))


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1500) -> Iterator[pa.RecordBatch]:
    """Batches cut to a number of rows, so that a task holds few of them as Python objects.

    After the last one Arrow gives back what it keeps for later: the worker may wait long.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    batch = None
    pa.default_memory_pool().release_unused()


def total_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts, which sizes the number of buckets."""
    row = docs.agg(F.sum(F.octet_length(F.col(column).cast("string"))).alias("n")).first()
    return int(row.n or 0) if row else 0
