"""Which load an input file belongs to, from the first look at it until it is archived.

A load claims a file by creating its claim, which only one load can. It marks
itself done once its result is published, archives its files and drops their
claims. So two runs never share a file, and a run that is lost in between leaves
one of two things: claims of a load that isn't done, whose files wait for that
load to be repeated under its id, or claims of one that is, whose files are
archived by whoever comes next and not applied again.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark import fs


class Share(NamedTuple):
    """Files as one load sees them."""

    own: list[str]       # to be applied by it
    applied: list[str]   # published by a load that is done, but not archived yet
    others: dict[str, int]   # file -> load that has claimed it and isn't done


class Claims:
    """Claims below a folder, one for each file name of each table."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _claim(self, table: str, file: str) -> str:
        return f"{self.root}/{table}/{file.rsplit('/', 1)[-1]}.claim"

    def _done(self, table: str, load_id: int) -> str:
        return f"{self.root}/{table}/load-{load_id}.done"

    def _holders(self, table: str, files: Sequence[str]) -> dict[str, int]:
        """The load that holds each of the files."""
        paths = {self._claim(table, file).rsplit("/", 1)[-1]: file for file in files}
        rows = self.spark.read.text([self._claim(table, f) for f in files]).select(
            F.element_at(F.split("_metadata.file_path", "/"), -1).alias("name"), "value").collect()
        return {paths[unquote(row["name"])]: int(row.value) for row in rows}

    def take(self, table: str, files: Sequence[str], load_id: int) -> Share:
        """Claim the files that nobody has, and sort out the others."""
        taken = [f for f in files
                 if not fs.put_new(self.spark, self._claim(table, f), f"{load_id}\n")]
        holders = self._holders(table, taken) if taken else {}
        done = {load for load in set(holders.values())
                if fs.exists(self.spark, self._done(table, load))}
        applied = [f for f in taken if holders[f] in done]
        others = {f: holders[f] for f in taken
                  if holders[f] not in done and holders[f] != load_id}
        gone = {*applied, *others}
        return Share([f for f in files if f not in gone], applied, others)

    def published(self, table: str, load_id: int) -> None:
        fs.put_new(self.spark, self._done(table, load_id), "")

    def drop(self, table: str, files: Sequence[str]) -> None:
        """Forget files that are archived; a file of that name may come again."""
        for file in files:
            fs.remove(self.spark, self._claim(table, file))

    def release(self, table: str, load_id: int, files: Sequence[str]) -> list[str]:
        """Give up files of a load that will never be repeated, for the next one to take."""
        if fs.exists(self.spark, self._done(table, load_id)):
            raise ValueError(f"load {load_id} of {table} is published; its files are applied")
        held = [f for f in files if fs.exists(self.spark, self._claim(table, f))]
        own = [f for f, load in (self._holders(table, held) if held else {}).items()
               if load == load_id]
        self.drop(table, own)
        return own
