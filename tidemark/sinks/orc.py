"""ORC writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.operators.layout import bloom_options, cluster

ZLIB = "zlib"


def write(df: DataFrame, path: str, *, mode: str = "overwrite",
          partition_by: Sequence[str] = (), distribute_by: Sequence[str] = (),
          sort_by: Sequence[str] = (), bloom: Sequence[str] = (),
          dynamic: bool = False, max_records: int | None = None) -> None:
    """Write ORC/ZLIB, clustered when partition or distribution columns are given.

    With ``dynamic`` an overwrite replaces just the partitions that occur in
    ``df``, which may come from the same path.
    """
    df = cluster(df, partition_by, distribute_by, sort_by or bloom)
    writer = df.write.mode(mode).option("compression", ZLIB).options(**bloom_options(bloom))
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.orc(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], **kw) -> None:
    write(df, path, partition_by=partition_by, dynamic=True, **kw)


def append(df: DataFrame, path: str, **kw) -> None:
    write(df, path, mode="append", **kw)
