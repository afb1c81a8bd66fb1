"""Change files as a stream: apply whatever has arrived, then stop."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark import schema as S
from tidemark.operators.changes import apply_changes, reduced_changes
from tidemark.operators.columns import with_derived_all
from tidemark.operators.merge import apply_in_partitions
from tidemark.session import staging
from tidemark.sinks.publish import Versions, replace_partitions
from tidemark.sources.changes_csv import stream_changes
from tidemark.sources.tables import snapshot

LoadTs = datetime | str | Callable[[int], datetime | str]


def _at(load_ts: LoadTs, batch_id: int) -> datetime | str:
    return load_ts(batch_id) if callable(load_ts) else load_ts


def _reduced(batch: DataFrame, keys: Sequence[str], options: dict) -> DataFrame:
    known = ("order", "op", "load_type", "null_safe", "delete_keys", "keep_newest")
    return reduced_changes(batch, keys, **{k: options[k] for k in known if k in options})


def apply_to_versions(root: str, schema: T.StructType, keys: Sequence[str], load_ts: LoadTs, *,
                      keep: int = 2, **options) -> Callable[[DataFrame, int], None]:
    """A batch writer that publishes a new version of the target per batch.

    Version 0 is the state before the stream. Batch ``n`` always starts from the
    newest version up to ``n`` and writes version ``n + 1``, so a batch that is
    delivered again gives the same result.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        versions = Versions(batch.sparkSession, root)
        newest = versions.current()
        if newest is not None and newest > batch_id + 1:
            raise ValueError(f"{root} is at version {newest}, ahead of batch {batch_id}: "
                             "the checkpoint belongs to another target")
        with staging(batch.sparkSession, "batch") as path:
            changes = snapshot(_reduced(batch, keys, options), path)
            if not changes.isEmpty():
                target = versions.read(schema, before=batch_id + 1)
                merged = apply_changes(target, changes, keys, load_ts=_at(load_ts, batch_id),
                                       **options)
                versions.publish(merged, batch_id + 1)
        versions.prune(max(keep, 2))
    return write


def _follow(rows: DataFrame, keys: Sequence[str], partition_by: Sequence[str],
            derived: dict[str, str] | None) -> bool:
    """Whether the partition columns can be worked out from the key columns alone."""
    try:
        known = with_derived_all(rows.select(*keys), derived).columns
    except AnalysisException:
        return False
    return set(partition_by) <= set(known)


def apply_to_partitions(path: str, schema: T.StructType, keys: Sequence[str],
                        partition_by: Sequence[str], load_ts: LoadTs, *,
                        derived: dict[str, str] | None = None,
                        **options) -> Callable[[DataFrame, int], None]:
    """A batch writer that rewrites only the partitions a batch concerns.

    For targets too large to rewrite whole. ``derived`` computes the partition
    columns; where it needs more than the key, partitions that hold a changed
    key's old row are rewritten as well. A batch delivered again deletes and
    inserts the same rows.
    ``schema`` includes the partition columns, last.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with staging(spark, "batch") as folder:
            reduced = with_derived_all(_reduced(batch, keys, options), derived)
            changes = snapshot(reduced, folder)
            if changes.isEmpty():
                return
            target = spark.read.schema(schema).orc(path)
            done = apply_in_partitions(target, changes, keys, partition_by,
                                       moved=not _follow(batch, keys, partition_by, derived),
                                       load_ts=_at(load_ts, batch_id), **options)
            replace_partitions(done.rows, done.touched, path, partition_by,
                               may_empty=done.may_empty)
    return write


def ingest(spark: SparkSession, directory: str, table: str, business: T.StructType,
           write: Callable[[DataFrame, int], None], checkpoint: str, *,
           archive: str | None = None, delimiter: str = "|", multi_line: bool = False) -> int:
    """Apply all files that arrived since the last run, as one batch; returns the batches run.

    Files are not dealt over batches: the newest change of a key wins wherever
    it stands, which only holds within a batch.
    """
    changes = stream_changes(spark, directory, table, business, delimiter=delimiter,
                             multi_line=multi_line, archive=archive)
    ran: list[int] = []

    def counted(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        ran.append(batch_id)

    query = (changes.writeStream.foreachBatch(counted)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return len(set(ran))


def target_schema(business: T.StructType, *, keep_newest: bool = False) -> T.StructType:
    """Business columns, then (kept) order column, deleted flag and load stamp."""
    extra = [T.StructField(S.TIME_KEY, T.StringType())] if keep_newest else []
    return T.StructType([*business.fields, *extra,
                         T.StructField(S.DELETED_FLAG, T.IntegerType()),
                         T.StructField(S.LOAD_STAMP, T.TimestampNTZType())])
