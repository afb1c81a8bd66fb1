"""A flat target kept file by file: a merge writes anew only files that hold an incoming key.

Below the root, ``files/<state>/`` holds the files of one load, ``index/<state>/``
bits of the hashed keys of each of them (see ``operators.keyfilter``), and a
manifest, kept as a numbered version, names the files that count with their rows
and the range of their first key column. Files are cut by key range when they are
written, so that keys that come in together meet few of them.

A merge finds its files in three steps, each on what the one before has left: the
range of the incoming keys against the manifest, their bits against the index, and
at last the key columns of the files themselves, which leaves no file by mistake.
Names of files come to the driver, rows don't. A merge counts once its manifest's
marker is there; files it doesn't touch keep their names.

One load at a time may write a target; any number may read it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fs
from tidemark.operators.columns import align
from tidemark.operators.keyed import as_bound, from_bound, key_set
from tidemark.operators.keyfilter import comparable, key_bits
from tidemark.operators.merge import merge_flat
from tidemark.operators.metrics import merge_metrics
from tidemark.sinks import orc
from tidemark.sinks.publish import Versions

PATH, ROWS, LOW, HIGH = "__path", "__rows", "__low", "__high"
_MARK = "~"


class FilesTarget:
    """An ORC target without partitions, merged by replacing files."""

    partition_by: list[str] = []

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str],
                 max_records: int = 5_000_000):
        """``max_records``: rows of a file, which is what a merge reads and writes at least."""
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self.max_records = max_records
        self.versions = Versions(spark, f"{self.root}/manifest")

    # ---- reading

    def exists(self) -> bool:
        return self.versions.current() is not None

    def manifest(self, version: int | None = None) -> DataFrame:
        """A row for each file that counts."""
        version = self.versions.current() if version is None else version
        if version is None:
            raise ValueError(f"{self.root} has no published state")
        return self.spark.read.orc(self.versions.path(version))

    @property
    def schema(self) -> T.StructType:
        """The target's columns, as told by the manifest."""
        line = self.manifest().agg(F.max("__schema")).first()[0]
        return T.StructType.fromJson(json.loads(line))

    def row_count(self) -> int:
        return self.manifest().agg(F.sum(ROWS)).first()[0] or 0

    def _read(self, paths: Sequence[str], schema: T.StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).orc([f"{self.root}/files/{p}" for p in paths])

    def files(self, version: int | None = None) -> list[str]:
        rows = self.manifest(version).where(F.col(ROWS) > 0).select(PATH).collect()
        return sorted(row[0] for row in rows)

    def read(self, version: int | None = None) -> DataFrame:
        return self._read(self.files(version), self.schema)

    # ---- writing

    def _write(self, df: DataFrame, load: str) -> DataFrame:
        """A new state: its files, its index and its part of the manifest."""
        state = f"{load}{_MARK}{uuid.uuid4().hex[:12]}"
        path = f"{self.root}/files/{state}"
        orc.write(df.repartitionByRange(*self.keys), path, sort_by=self.keys,
                  max_records=self.max_records)
        own = self.spark.read.schema(df.schema).orc(path)
        named = own.select(*self.keys, F.concat(
            F.lit(f"{state}/"), F.element_at(F.split("_metadata.file_path", "/"), -1)).alias(PATH))
        key_bits(named, self.keys, by=[PATH]).write.option("compression", orc.ZLIB).orc(
            f"{self.root}/index/{state}")
        first, kind = F.col(self.keys[0]), df.schema[self.keys[0]].dataType
        # ranges as text survive any later change of the key's type
        found = named.groupBy(PATH).agg(
            F.count(F.lit(1)).alias(ROWS), as_bound(F.min(first), kind).alias(LOW),
            as_bound(F.max(first), kind).alias(HIGH),
            F.count_if(first.isNull()).alias("__nulls"))
        # a row without a file holds the schema, also of a target without rows
        return found.unionByName(self.spark.range(1).select(
            F.lit(f"{state}/").alias(PATH), F.lit(0).cast("long").alias(ROWS),
            F.lit(None).cast("string").alias(LOW), F.lit(None).cast("string").alias(HIGH),
            F.lit(0).cast("long").alias("__nulls")))

    def _publish(self, manifest: DataFrame, schema: T.StructType) -> None:
        number = (self.versions.current() or 0) + 1
        plain = manifest.drop("__schema").withColumn("__schema", F.lit(schema.json()))
        self.versions.publish(plain, number)
        self.prune()

    def redefine(self, df: DataFrame, state: str, partition_by: Sequence[str] = (),
                 distribute_by: Sequence[str] = ()) -> None:
        """New contents and columns."""
        if partition_by:
            raise ValueError("a target kept by files has no partitions")
        self._publish(self._write(df, state), df.schema)

    def replace(self, df: DataFrame, state: str, distribute_by: Sequence[str] = ()) -> None:
        self.redefine(df.select(*self.schema.names), state)

    def append(self, df: DataFrame, distribute_by: Sequence[str] = (),
               state: str | None = None) -> None:
        """Add rows; repeated under the same ``state``, they take the place of the first ones."""
        kept, schema = self.manifest(), self.schema
        if state is not None:
            kept = kept.where(~F.col(PATH).startswith(f"{state}{_MARK}"))
        added = self._write(df.select(*schema.names), state or "append")
        self._publish(kept.drop("__schema").unionByName(added), schema)

    def touched(self, incoming: DataFrame, keys: Sequence[str], *,
                null_safe: bool = False) -> list[str]:
        """Files that hold an incoming key."""
        schema = self.schema
        wanted = key_set(incoming, keys, null_safe)
        files = self.manifest().where(F.col(ROWS) > 0)
        if self.keys[0] in keys:
            files = files.where(self._in_range(wanted, schema[self.keys[0]].dataType))
        names = [row[0] for row in files.select(PATH).collect()]
        if names and set(keys) == set(self.keys) and comparable(
                self._read([], schema), wanted, self.keys):
            states = sorted({name.rsplit("/", 1)[0] for name in names})
            index = self.spark.read.orc([f"{self.root}/index/{s}" for s in states])
            may = key_bits(wanted, self.keys).toDF("__word", "__bits")
            held = (index.where(F.col(PATH).isin(names)) if len(names) <= 1000 else index)
            met = held.join(may, (F.col("word") == F.col("__word"))
                            & (F.col("bits").bitwiseAND(F.col("__bits")) != 0), "left_semi")
            names = sorted(set(names) & {r[0] for r in met.select(PATH).distinct().collect()})
        if not names:
            return []
        named = self._read(names, schema).select(*keys, F.col("_metadata.file_path").alias(PATH))
        aliases = [f"__key_{i}" for i in range(len(keys))]
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n))
                                           for k, n in zip(keys, aliases)])
        held = named.join(wanted.toDF(*aliases), same, "left_semi").select(PATH).distinct()
        return sorted("/".join(row[0].rsplit("/", 2)[1:]) for row in held.collect())

    def _in_range(self, wanted: DataFrame, kind: T.DataType) -> Column:
        """Files whose first key column overlaps the incoming range, or shares its nulls."""
        key = F.col(self.keys[0])
        row = wanted.agg(as_bound(F.min(key), kind).alias("lo"),
                         as_bound(F.max(key), kind).alias("hi"),
                         F.count_if(key.isNull()).alias("nulls")).first()
        fits = F.lit(False)
        if row.lo is not None:
            fits = ((_typed(LOW, kind) <= from_bound(row.hi, kind))
                    & (_typed(HIGH, kind) >= from_bound(row.lo, kind)))
        return F.coalesce(fits, F.lit(False)) | (F.lit(row.nulls > 0) & (F.col("__nulls") > 0))

    def merge_files(self, incoming: DataFrame, keys: Sequence[str], state: str, *,
                    null_safe: bool = False) -> dict[str, int]:
        """Merge staged rows; returns the counts of the load."""
        schema = self.schema
        incoming = align(incoming, schema.names)
        names = self.touched(incoming, keys, null_safe=null_safe)
        old = self._read(names, schema)
        found = merge_metrics(old, incoming, keys, null_safe=null_safe).first()
        added = self._write(merge_flat(old, incoming, keys, null_safe=null_safe)
                            .select(*schema.names), state)
        kept = self.manifest().drop("__schema")
        if names:
            gone = self.spark.createDataFrame([(n,) for n in names], f"{PATH} string")
            kept = kept.join(gone, PATH, "left_anti")
        self._publish(kept.unionByName(added), schema)
        return {"rows_inserted": found.rows_incoming, "rows_updated": found.rows_updated,
                "rows_deleted": found.rows_updated}

    # ---- removing

    def prune(self, keep: int = 2) -> int:
        """Remove manifests but the newest ``keep``, and files that none of these names."""
        self.versions.prune(keep)
        kept = {row[0] for v in self.versions.complete()
                for row in self.manifest(v).select(PATH).collect()}
        states = {path.split("/", 1)[0] for path in kept if not path.endswith("/")}
        gone = 0
        for state in fs.names(self.spark, f"{self.root}/files"):
            if state not in states:
                fs.remove(self.spark, f"{self.root}/files/{state}")
                fs.remove(self.spark, f"{self.root}/index/{state}")
                continue
            for name in fs.names(self.spark, f"{self.root}/files/{state}"):
                if name.startswith("part-") and f"{state}/{name}" not in kept:
                    gone += fs.remove(self.spark, f"{self.root}/files/{state}/{name}")
        return gone


def _typed(column: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.col(column).cast("long"))
    if isinstance(kind, T.BinaryType):
        return F.unhex(column)
    return F.col(column).cast(kind)
