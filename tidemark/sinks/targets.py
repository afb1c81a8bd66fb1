"""Where a load ends up: a catalog ORC table or a database table."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark import fs
from tidemark.sinks import jdbc as jdbc_sink
from tidemark.sinks import orc
from tidemark.sinks.publish import (append_files, create_table, redefine_table, refresh,
                                    replace_partitions, switch_location, touched_rows)
from tidemark.sources import jdbc as jdbc_source
from tidemark.sources.tables import bloom_columns, partition_columns


class TableTarget:
    """An ORC table whose data lives in one folder per published state below ``root``.

    A whole-table change is written to a new folder and the table is switched
    over; partition changes and appends go into the current folder.
    """

    def __init__(self, spark: SparkSession, table: str, root: str):
        self.spark, self.table, self.root = spark, table, root.rstrip("/")

    @property
    def _next(self) -> str:
        return f"{self.table}__next"

    def exists(self) -> bool:
        """Whether the catalog has the table; a definition step that was cut short is finished."""
        if self.spark.catalog.tableExists(self.table):
            return True
        if self.spark.catalog.tableExists(self._next):
            self.spark.sql(f"ALTER TABLE {self._next} RENAME TO {self.table}")
            return True
        return False

    def states(self) -> list[str]:
        """Published states below the root, whether or not the catalog knows the table."""
        return [name for name in fs.names(self.spark, self.root) if name.startswith("load")
                and fs.exists(self.spark, f"{self.root}/{name}/_SUCCESS")]

    def check_known(self) -> None:
        """A keyed or append load must find the rows that are there."""
        if not self.exists() and self.states():
            raise ValueError(
                f"{self.table} is not in the catalog, but {self.root} holds "
                f"{', '.join(self.states())}: define the table over its current state, or run "
                "a full load to replace it")

    @property
    def location(self) -> str:
        facts = self.spark.sql(f"DESCRIBE EXTENDED {self.table} AS JSON").first()
        return json.loads(facts.json_metadata)["location"]

    @property
    def partition_by(self) -> list[str]:
        return partition_columns(self.spark, self.table)

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def create(self, schema: T.StructType, state: str, partition_by: Sequence[str] = (),
               bloom: Sequence[str] = ()) -> None:
        create_table(self.spark, self.table, schema, f"{self.root}/{state}", partition_by, bloom)

    def _layout(self, distribute_by: Sequence[str]) -> dict:
        bloom = bloom_columns(self.spark, self.table)
        return {"distribute_by": distribute_by, "bloom": bloom, "sort_by": bloom}

    def _fresh(self, state: str) -> str:
        """A folder for a new state; a repeated load gets one of its own."""
        path, n = f"{self.root}/{state}", 1
        while fs.exists(self.spark, path):
            n += 1
            path = f"{self.root}/{state}-{n}"
        return path

    def redefine(self, df: DataFrame, state: str, partition_by: Sequence[str] = (),
                 distribute_by: Sequence[str] = ()) -> None:
        """New contents and columns; the old definition goes once the data is written."""
        old = self.location if self.exists() else None
        bloom = [c for c in (bloom_columns(self.spark, self.table) if old else [])
                 if c in df.columns]
        path = self._fresh(state)
        orc.write(df, path, partition_by=partition_by, distribute_by=distribute_by,
                  bloom=bloom, sort_by=bloom)
        same = old and self.spark.table(self.table).schema.simpleString() == \
            df.schema.simpleString() and self.partition_by == list(partition_by)
        if same:
            switch_location(self.spark, self.table, path)
        else:
            redefine_table(self.spark, self.table, df.schema, path, partition_by, bloom,
                           under=self._next)
        refresh(self.spark, self.table)
        self._prune(old)

    def replace(self, df: DataFrame, state: str, distribute_by: Sequence[str] = ()) -> None:
        parts, old = self.partition_by, self.location
        path = self._fresh(state)
        orc.write(df, path, partition_by=parts, **self._layout(distribute_by))
        switch_location(self.spark, self.table, path)
        refresh(self.spark, self.table)
        self._prune(old)

    def _prune(self, previous: str | None) -> None:
        """Remove states before the previous one, which running readers may still use.

        Without a known previous state nothing is removed: the folders may be
        all there is of a table that the catalog has lost.
        """
        if previous is None:
            return
        kept = {p.rstrip("/").rsplit("/", 1)[-1] for p in (self.location, previous) if p}
        for name in fs.names(self.spark, self.root):
            if name.startswith("load") and name not in kept:
                fs.remove(self.spark, f"{self.root}/{name}")

    def append(self, df: DataFrame, distribute_by: Sequence[str] = (),
               state: str | None = None) -> None:
        """Add rows; repeated under the same ``state``, they take the place of the first ones.

        The rows are written aside and their files moved in under names that
        begin with the state, so a run that is lost in between leaves files its
        repetition removes.
        """
        parts = self.partition_by
        touched = touched_rows(df, parts) if parts else None
        if state is None:
            orc.append(df, self.location, partition_by=parts, **self._layout(distribute_by))
        else:
            append_files(df, self.location, state, parts, **self._layout(distribute_by))
        refresh(self.spark, self.table, touched=touched)

    def replace_partitions(self, df: DataFrame, touched: DataFrame,
                           distribute_by: Sequence[str] = (), may_empty: bool = False) -> None:
        parts, location = self.partition_by, self.location
        # named before the write, as ``touched`` may be read out of the target
        rows = touched_rows(touched, parts)
        replace_partitions(df, touched, location, parts, may_empty=may_empty,
                           **self._layout(distribute_by))
        emptied = []
        if rows and may_empty:
            named = self.spark.createDataFrame(rows, T.StructType([df.schema[p] for p in parts]))
            files = self.spark.read.schema(df.schema).orc(location)
            left = files.join(named, parts, "left_semi").select(*parts).distinct()
            emptied = sorted(set(rows) - {tuple(r) for r in left.collect()}, key=repr)
        refresh(self.spark, self.table, touched=rows, emptied=emptied)


class JdbcTarget:
    """A database table. Keyed loads are merged inside the database."""

    def __init__(self, spark: SparkSession, url: str, table: str,
                 connection: dict[str, str] | None = None):
        self.spark, self.url, self.table = spark, url, table
        self.connection = connection or {}

    partition_by: list[str] = []

    def exists(self) -> bool:
        return jdbc_sink.exists(self.spark, self.url, self.table, self.connection)

    def create(self, schema: T.StructType) -> None:
        """A table for rows of that schema, unless there is one."""
        jdbc_sink.create(self.spark, self.url, self.table, schema, self.connection)

    def read(self) -> DataFrame:
        return jdbc_source.read(self.spark, self.url, table=self.table,
                                connection=self.connection)

    def replace(self, df: DataFrame, state: str, distribute_by: Sequence[str] = ()) -> None:
        jdbc_sink.replace(df, self.url, self.table, connection=self.connection)

    def append(self, df: DataFrame, distribute_by: Sequence[str] = (),
               state: str | None = None) -> None:
        jdbc_sink.append(df, self.url, self.table, connection=self.connection)

    def merge_rows(self, rows: DataFrame, keys: Sequence[str], load_type: str, null_safe: bool,
                   deletes: DataFrame | None = None) -> list[int]:
        """Rows each of the database's statements touched."""
        return jdbc_sink.merge(rows, self.url, self.table, keys, load_type=load_type,
                               null_safe=null_safe, deletes=deletes,
                               connection=self.connection)
