"""A target whose partitions are named by a versioned manifest.

Below the root, ``data/__state=<state>/`` holds what one load wrote, by partition,
and never changes. A manifest, kept as a numbered version, has a row for each
partition that a state holds, with its number of rows. Readers take the newest
manifest and only those folders it names. So a load that rewrites any number of
partitions is seen whole or not at all: what counts is the one marker of its
manifest. Partitions that end up empty are just not named any more, and an append
names a second state of the same partition; nothing is moved or listed for either.
It needs no catalog.

One load at a time may write a target; any number may read it. A load that died
leaves folders that no manifest names, for ``prune`` to remove.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fs
from tidemark.sinks import orc
from tidemark.sinks.publish import Versions

STATE = "__state"
ROWS = "__rows"
#: Between a load's name and the rest of a state's.
_MARK = "~"


class ManifestTarget:
    """An ORC target, partitioned or flat, published by one marker."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.versions = Versions(spark, f"{self.root}/manifest")

    # ---- what there is

    def exists(self) -> bool:
        return self.versions.current() is not None

    def _definitions(self) -> list[int]:
        return [int(n[:-5]) for n in fs.names(self.spark, f"{self.root}/definition")
                if n.endswith(".json") and n[:-5].isdigit()]

    def _definition(self, version: int) -> dict:
        number = max(n for n in self._definitions() if n <= version)
        line = self.spark.read.text(self._definition_path(number)).first().value
        return json.loads(line)

    def _definition_path(self, number: int) -> str:
        return f"{self.root}/definition/{number:015d}.json"

    def _current(self) -> int:
        version = self.versions.current()
        if version is None:
            raise ValueError(f"{self.root} has no published state")
        return version

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self._definition(self._current())["schema"])

    @property
    def partition_by(self) -> list[str]:
        return self._definition(self._current())["partition_by"]

    def _manifest_schema(self, schema: T.StructType, parts: Sequence[str]) -> T.StructType:
        return T.StructType([*(schema[p] for p in parts), T.StructField(STATE, T.StringType()),
                             T.StructField(ROWS, T.LongType())])

    def manifest(self, version: int | None = None) -> DataFrame:
        """Partition columns, state and number of rows of every partition that counts."""
        version = self._current() if version is None else version
        found = self._definition(version)
        schema = T.StructType.fromJson(found["schema"])
        return (self.spark.read.schema(self._manifest_schema(schema, found["partition_by"]))
                .orc(self.versions.path(version)))

    def row_count(self) -> int:
        """Rows of the target, out of the manifest."""
        return self.manifest().agg(F.sum(ROWS)).first()[0] or 0

    # ---- reading

    def _path(self, state: str) -> str:
        return f"{self.root}/data/{STATE}={state}"

    def _files(self, states: Sequence[str], schema: T.StructType,
               parts: Sequence[str]) -> DataFrame:
        fields = [*(f for f in schema if f.name not in parts), T.StructField(STATE, T.StringType()),
                  *(schema[p] for p in parts)]
        return (self.spark.read.schema(T.StructType(fields))
                .option("basePath", f"{self.root}/data").orc([self._path(state) for state in states]))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the newest manifest, or of a kept older one.

        Names of states come to the driver, one for each load that still counts.
        Partitions are chosen by a semi-join, which prunes folders while the
        manifest is small enough to be broadcast and drops their rows beyond that.
        """
        version = self._current() if version is None else version
        found = self._definition(version)
        schema, parts = T.StructType.fromJson(found["schema"]), found["partition_by"]
        # the condition holds for all rows; it tells Spark that pruning by them is worth a try
        named = self.manifest(version).where(F.col(ROWS) > 0)
        null = reduce(lambda a, b: a | b, [F.col(p).isNull() for p in parts], F.lit(False))
        facts = named.agg(F.collect_set(STATE).alias("states"), F.max(null).alias("null")).first()
        if not facts.states:
            return self.spark.createDataFrame([], schema)
        rows = self._files(sorted(facts.states), schema, parts)
        names = [f"__part_{i}" for i in range(len(parts) + 1)]
        named = named.select(STATE, *parts).toDF(*names)

        def same(column: str, name: str) -> Column:
            if facts.null and column != STATE:
                return F.col(column).eqNullSafe(F.col(name))
            return F.col(column) == F.col(name)

        condition = reduce(lambda a, b: a & b, map(same, [STATE, *parts], names))
        return rows.join(named, condition, "left_semi").select(*schema.names)

    # ---- writing

    def _next(self) -> int:
        return max([self.versions.current() or 0, *self._definitions()]) + 1

    def _write(self, df: DataFrame, load: str, definition: dict,
               distribute_by: Sequence[str] = ()) -> DataFrame:
        """A new state and its part of the manifest."""
        state = f"{load}{_MARK}{uuid.uuid4().hex[:12]}"
        parts, bloom = definition["partition_by"], definition["bloom"]
        schema = T.StructType.fromJson(definition["schema"])
        orc.write(df.select(*schema.names), self._path(state), partition_by=parts,
                  distribute_by=distribute_by, bloom=bloom, sort_by=bloom)
        # a scan of no columns but those in folder names
        return (self._files([state], schema, parts).groupBy(*parts)
                .agg(F.count(F.lit(1)).alias(ROWS)).where(F.col(ROWS) > 0)
                .select(*parts, F.lit(state).alias(STATE), ROWS))

    def _publish(self, manifest: DataFrame, number: int) -> None:
        self.versions.publish(manifest, number)
        self.prune()

    def redefine(self, df: DataFrame, state: str, partition_by: Sequence[str] = (),
                 distribute_by: Sequence[str] = (), bloom: Sequence[str] = ()) -> None:
        """New contents and columns; the old ones count until the manifest's marker is there."""
        number = self._next()
        if not bloom and self.exists():
            bloom = [c for c in self._definition(self._current())["bloom"] if c in df.columns]
        rest = [f for f in df.schema if f.name not in partition_by]
        schema = T.StructType([*rest, *(df.schema[p] for p in partition_by)])
        definition = {"schema": schema.jsonValue(), "partition_by": list(partition_by),
                      "bloom": list(bloom)}
        if not fs.put_new(self.spark, self._definition_path(number), json.dumps(definition) + "\n"):
            raise ValueError(f"another load is redefining {self.root}")
        self._publish(self._write(df, state, definition, distribute_by), number)

    def create(self, schema: T.StructType, state: str, partition_by: Sequence[str] = (),
               bloom: Sequence[str] = ()) -> None:
        """An empty target, unless there is one."""
        if not self.exists():
            self.redefine(self.spark.createDataFrame([], schema), state, partition_by, bloom=bloom)

    def replace(self, df: DataFrame, state: str, distribute_by: Sequence[str] = ()) -> None:
        definition, number = self._definition(self._current()), self._next()
        self._publish(self._write(df, state, definition, distribute_by), number)

    def append(self, df: DataFrame, distribute_by: Sequence[str] = (),
               state: str | None = None) -> None:
        """Add rows; repeated under the same ``state``, they take the place of the first ones."""
        definition, number = self._definition(self._current()), self._next()
        kept = self.manifest()
        if state is not None:
            kept = kept.where(~F.col(STATE).startswith(f"{state}{_MARK}"))
        added = self._write(df, state or "append", definition, distribute_by)
        self._publish(kept.unionByName(added), number)

    def replace_partitions(self, df: DataFrame, touched: DataFrame,
                           distribute_by: Sequence[str] = (), may_empty: bool = False) -> None:
        """Make ``df`` the new contents of the ``touched`` partitions, all at once.

        Partitions that ``df`` has rows for count as touched too, and those it
        has none for are empty from now on, whether or not that was expected.
        """
        definition, number = self._definition(self._current()), self._next()
        parts = definition["partition_by"]
        added = self._write(df, f"part{number}", definition, distribute_by)
        names = [f"__part_{i}" for i in range(len(parts))]
        gone = touched.select(*parts).unionByName(added.select(*parts)).distinct().toDF(*names)
        same = reduce(lambda a, b: a & b,
                      [F.col(p).eqNullSafe(F.col(n)) for p, n in zip(parts, names)])
        kept = self.manifest().join(gone, same, "left_anti")
        self._publish(kept.unionByName(added), number)

    # ---- removing

    def _kept_states(self) -> set[str]:
        return {row[0] for v in self.versions.complete()
                for row in self.manifest(v).select(STATE).distinct().collect()}

    def prune(self, keep: int = 2) -> list[str]:
        """Remove manifests but the newest ``keep``, and states that none of these names."""
        self.versions.prune(keep)
        kept = self._kept_states()
        gone = [name for name in fs.names(self.spark, f"{self.root}/data")
                if name.startswith(f"{STATE}=") and name.split("=", 1)[1] not in kept]
        for name in gone:
            fs.remove(self.spark, f"{self.root}/data/{name}")
        return gone

    def vacuum(self) -> int:
        """Remove the partition folders of kept states that no kept manifest names any more.

        Lists every file once; returns how many folders went.
        """
        versions, states = self.versions.complete(), sorted(self._kept_states())
        if not states or not self.partition_by:
            return 0
        definition = self._definition(versions[-1])
        schema, parts = T.StructType.fromJson(definition["schema"]), definition["partition_by"]
        named = reduce(DataFrame.unionByName,
                       [self.manifest(v).select(STATE, *parts) for v in versions]).distinct()
        names = [f"__part_{i}" for i in range(len(parts) + 1)]
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n))
                                           for c, n in zip([STATE, *parts], names)])
        folders = (self._files(states, schema, parts)
                   .select(STATE, *parts, F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
                           .alias("folder")).distinct()
                   .join(named.toDF(*names), same, "left_anti").select("folder"))
        gone = 0
        for row in folders.toLocalIterator():
            gone += fs.remove(self.spark, unquote(row.folder))
        return gone
