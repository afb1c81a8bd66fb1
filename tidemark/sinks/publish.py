"""Making a finished result the new state of a target."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import date
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fs
from tidemark.session import staging
from tidemark.sinks import orc
from tidemark.sinks.text import write_change_csv
from tidemark.sources.tables import partition_columns, snapshot


class Versions:
    """A target kept as numbered, complete copies below one folder.

    A version counts once its ``_SUCCESS`` marker is there, which the write's
    own commit creates last. Readers take the newest such version, so they
    never see half a write, and a lost driver leaves the old state in place.
    Writing a version again replaces it whole.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, version: int) -> str:
        return f"{self.root}/v{version:015d}"

    def complete(self, before: int | None = None) -> list[int]:
        found = [int(n[1:]) for n in fs.names(self.spark, self.root)
                 if n.startswith("v") and n[1:].isdigit()]
        return [v for v in sorted(found)
                if (before is None or v < before)
                and fs.exists(self.spark, f"{self.path(v)}/_SUCCESS")]

    def current(self, before: int | None = None) -> int | None:
        for version in reversed(self.complete(before)):
            return version
        return None

    def read(self, schema: T.StructType, before: int | None = None) -> DataFrame:
        """The newest complete version; no rows when there is none."""
        version = self.current(before)
        if version is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).orc(self.path(version))

    def publish(self, df: DataFrame, version: int, **layout) -> str:
        orc.write(df, self.path(version), **layout)
        return self.path(version)

    def prune(self, keep: int = 2) -> list[int]:
        """Remove all but the newest ``keep`` complete versions."""
        old = self.complete()[:-keep] if keep else []
        for version in old:
            fs.remove(self.spark, self.path(version))
        return old


def replace_partitions(df: DataFrame, touched: DataFrame, path: str,
                       partition_by: Sequence[str], *, may_empty: bool = False,
                       **layout) -> None:
    """Make ``df`` the new contents of the ``touched`` partitions.

    A dynamic overwrite replaces partitions that still have rows. One that has
    none left occurs nowhere in ``df``; where that can happen (``may_empty``)
    such folders are listed before the write, in staging, and removed after it.
    ``df`` has the target's columns.
    """
    spark = df.sparkSession
    if not may_empty:
        orc.overwrite_partitions(df, path, partition_by, **layout)
        return
    names = [f"__part_{i}" for i in range(len(partition_by))]
    same = reduce(lambda a, b: a & b,
                  [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(partition_by, names)])
    with staging(spark, "merged") as merged, staging(spark, "touched") as listed:
        # staged, so that the merge behind them runs once
        _replace_listed(snapshot(df, merged), snapshot(touched, listed), path, partition_by,
                        names, same, layout)


def _replace_listed(df: DataFrame, touched: DataFrame, path: str, partition_by: Sequence[str],
                    names: list[str], same, layout: dict) -> None:
    spark = df.sparkSession
    emptied = touched.join(df.select(*partition_by).distinct().toDF(*names), same, "left_anti")
    files = spark.read.schema(df.schema).orc(path).select(*partition_by, "_metadata.file_path")
    folders = (files.join(emptied.toDF(*names), same, "left_semi")
               .select(F.regexp_replace("file_path", "/[^/]*$", "")).distinct())
    with staging(spark, "emptied") as listing:
        folders.write.text(listing)
        orc.overwrite_partitions(df, path, partition_by, **layout)
        for row in spark.read.text(listing).toLocalIterator():
            fs.remove(spark, unquote(row.value))


def append_files(df: DataFrame, path: str, state: str, partition_by: Sequence[str] = (),
                 **layout) -> None:
    """Add ``df``'s files to a table folder under names that begin with ``state``.

    Files of that state that are there already are removed first. Only file
    names pass through the driver.
    """
    spark = df.sparkSession
    depth = "/*" * len(partition_by)
    with staging(spark, "append") as folder:
        orc.write(df, folder, partition_by=partition_by, **layout)
        for file in fs.glob(spark, f"{path}{depth}/{state}_*"):
            fs.remove(spark, file)
        for file in fs.glob(spark, f"{folder}{depth}/part-*"):
            *parts, name = file.rsplit("/", len(partition_by) + 1)[1:]
            target = "/".join([path, *parts])
            fs.make_dirs(spark, target)
            fs.move(spark, file, f"{target}/{state}_{name}")


def create_table(spark: SparkSession, table: str, schema: T.StructType, path: str,
                 partition_by: Sequence[str] = (), bloom: Sequence[str] = ()) -> None:
    """An ORC table over ``path``; an existing one stays as it is."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    props = ["'orc.compress'='ZLIB'"]
    if bloom:
        props.append(f"'orc.bloom.filter.columns'='{','.join(bloom)}'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING ORC{parts} "
              f"LOCATION '{path}' TBLPROPERTIES ({', '.join(props)})")


def redefine_table(spark: SparkSession, table: str, schema: T.StructType, path: str,
                   partition_by: Sequence[str] = (), bloom: Sequence[str] = (), *,
                   under: str) -> None:
    """New definition, as a full load does when the source's columns rule.

    It is made ``under`` another name before the old one goes, and renamed
    after; whoever finds only that other name can finish the step.
    """
    spark.sql(f"DROP TABLE IF EXISTS {under}")
    create_table(spark, under, schema, path, partition_by, bloom)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {under} RENAME TO {table}")


def switch_location(spark: SparkSession, table: str, path: str) -> None:
    """Point a table at another folder: one catalog update, no file moves."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def stage_and_switch(df: DataFrame, table: str, folder: str, **layout) -> None:
    """Write next to the live data, then switch the table over.

    Safe when ``df`` reads ``table``: the old folder is not touched.
    """
    orc.write(df, folder, **layout)
    switch_location(df.sparkSession, table, folder)


#: Partitions that are registered by name; where a load touches more, the table is listed.
MOST_REGISTERED = 1000


def touched_rows(partitions: DataFrame, columns: Sequence[str]) -> list[tuple] | None:
    """Values of the touched partitions, for :func:`refresh`; None if they can't be named.

    Their number is checked. NULL has no name that every statement takes.
    """
    rows = [tuple(r) for r in
            partitions.select(*columns).distinct().limit(MOST_REGISTERED + 1).collect()]
    if len(rows) > MOST_REGISTERED or any(value is None for row in rows for value in row):
        return None
    return rows


def _partition(columns: Sequence[str], row: tuple) -> str:
    def text(value) -> str:
        plain = str(value).lower() if isinstance(value, bool) else str(value)
        return "'" + plain.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return "PARTITION (" + ", ".join(f"`{c}`={text(v)}" for c, v in zip(columns, row)) + ")"


def refresh(spark: SparkSession, table: str, *, count_rows: bool = False,
            touched: Sequence[tuple] | None = None, emptied: Sequence[tuple] = ()) -> None:
    """Make new files known, match the listed partitions to the folders, refresh statistics.

    Where a load knows which partitions it has ``touched``, and which of them it
    has ``emptied``, only these are registered, dropped and measured; otherwise
    the whole table is listed. Row counts need a pass over the data, so they are
    taken on request only.
    """
    how = "" if count_rows else " NOSCAN"
    columns = partition_columns(spark, table)
    if not columns or touched is None:
        if columns:
            spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
        spark.catalog.refreshTable(table)
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{how}")
        return
    kept = [row for row in touched if row not in set(emptied)]
    if kept:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS "
                  + " ".join(_partition(columns, row) for row in kept))
    if emptied:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS "
                  + ", ".join(_partition(columns, row) for row in emptied))
    spark.catalog.refreshTable(table)
    for row in kept:
        spark.sql(f"ANALYZE TABLE {table} {_partition(columns, row)} COMPUTE STATISTICS{how}")


def archive_copy(df: DataFrame, root: str, table: str, load_id: int) -> str:
    """Keep a copy of a loaded table under ``<root>/<table>_bkp/load_id=<id>``."""
    path = f"{root.rstrip('/')}/{table}_bkp/load_id={load_id}"
    orc.write(df, path)
    return f"{root.rstrip('/')}/{table}_bkp"


def archive_inputs(spark: SparkSession, files: Sequence[str], root: str, schema: str,
                   table: str, day: date) -> list[str]:
    """Move applied files to ``<root>/<schema>/<yyyy-mm-dd>/<table>/``."""
    folder = f"{root.rstrip('/')}/{schema}/{day.isoformat()}/{table}"
    fs.make_dirs(spark, folder)
    moved = []
    for file in files:
        target, n = f"{folder}/{file.rsplit('/', 1)[-1]}", 1
        while fs.exists(spark, target):  # a file of that name came earlier the same day
            n += 1
            target = f"{folder}/{n}-{file.rsplit('/', 1)[-1]}"
        fs.move(spark, file, target)
        moved.append(target)
    return moved


def fan_out(df: DataFrame, staged_at: str, targets: Iterable[tuple[object, Callable]]) -> list:
    """One extract, many targets: stage it once, hand it to each target's loader.

    Staging instead of a cache: every loader reads the same rows even when
    executors are lost between two of them.
    """
    orc.write(df, staged_at)
    staged = df.sparkSession.read.schema(df.schema).orc(staged_at)
    return [(target, load(staged)) for target, load in targets]


def drop_files(df: DataFrame, directory: str, table: str, batch: str, **csv) -> list[str]:
    """Write rows as change files ``<batch>_<n>-<table>.csv`` and move them in place."""
    spark = df.sparkSession
    moved = []
    with staging(spark, "drop") as folder:
        write_change_csv(df, folder, **csv)
        fs.make_dirs(spark, directory)
        for i, file in enumerate(fs.glob(spark, f"{folder}/part-*.csv")):
            target = f"{directory.rstrip('/')}/{batch}_{i:05d}-{table}.csv"
            fs.move(spark, file, target)
            moved.append(target)
    return moved
