"""The control table as a log of events, so that runs don't lose one another's updates.

A state is a base (a numbered version of all control rows) and the events with
higher numbers. An event says which columns of which rows got which values. It
is created under the next number, whole and only if there is none of that
number: of two runs that worked on the same state one gets the number, the other
reads the new state and works its update out again. So updates are in one order,
and a value that follows from an older one (the second-last watermark) is right.
Readers reduce events to the newest value per row and column.

Control rows are told apart by id and route.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fs
from tidemark.control import table as control_table
from tidemark.sinks.publish import Versions

EVENT = "number long, id int, data_path string, column string, value string"
KEYS = ["id", "data_path"]


def newest_values(events: DataFrame) -> DataFrame:
    """Per row and column the value set last; NULL is a value like others."""
    return (events.groupBy(*KEYS, "column")
            .agg(F.max_by(F.struct("value"), "number").alias("set"))
            .select(*KEYS, "column", "set.value"))


def with_events(control: DataFrame, events: DataFrame) -> DataFrame:
    """Control rows with the newest values that events gave their columns.

    Rows are gathered by row and column only, so a row that a third of all
    events concern reaches a task once for each column and map task.
    """
    names = [f"__{key}" for key in KEYS]
    changed = (newest_values(events).groupBy(*KEYS)
               .agg(F.map_from_entries(F.collect_list(F.struct("column", "value")))
                    .alias("__set")).toDF(*names, "__set"))
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(KEYS, names)]

    def value(field: T.StructField) -> Column:
        if field.name in KEYS:
            return F.col(field.name)
        put = F.try_element_at("__set", F.lit(field.name)).cast(field.dataType)
        return (F.when(F.map_contains_key("__set", field.name), put)
                .otherwise(F.col(field.name)).alias(field.name))

    return control.join(changed, same, "left").select(*map(value, control.schema.fields))


def differences(state: DataFrame, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What a change of the rows' columns sets: row, column and value as text."""
    columns = [c for c in state.columns if c not in KEYS]
    after = change(state.select("*", *[F.col(c).alias(f"__was_{c}") for c in columns]))
    entries = F.array(*[
        F.when(~F.col(c).eqNullSafe(F.col(f"__was_{c}")),
               F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")))
        for c in columns])
    return after.select(*KEYS, F.explode(F.filter(entries, lambda e: e.isNotNull())).alias("set")
                        ).select(*KEYS, "set.*").distinct()


class ControlLog:
    """Control rows below a folder, updated by any number of runs at a time."""

    def __init__(self, spark: SparkSession, root: str, fold_after: int = 50):
        self.spark, self.fold_after = spark, fold_after
        self.base = Versions(spark, root)
        self.events = f"{self.base.root}/events"
        self.schema = spark.createDataFrame([], control_table.SCHEMA).schema

    def _event(self, number: int) -> str:
        return f"{self.events}/{number:015d}.json"

    def _numbers(self) -> list[int]:
        return [int(n[:-5]) for n in fs.names(self.spark, self.events)
                if n.endswith(".json") and n[:-5].isdigit()]

    def _known(self) -> tuple[int | None, list[int]]:
        """The newest base and the events since; the base first, as it may only get newer."""
        base = self.base.current()
        return base, [n for n in self._numbers() if base is None or n > base]

    def _state(self, base: int | None, numbers: list[int]) -> DataFrame:
        rows = (self.spark.createDataFrame([], self.schema) if base is None else
                self.spark.read.schema(self.schema).orc(self.base.path(base)))
        if not numbers:
            return rows
        events = self.spark.read.schema(EVENT).json([self._event(n) for n in numbers])
        return with_events(rows, events)

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """All control rows as they are now."""
        return self._state(*self._known())

    def publish(self, rows: DataFrame, version: int) -> str:
        """New control rows; events up to that number are no longer looked at."""
        return self.base.publish(rows.select(*self.schema.names), version)

    def update(self, change: Callable[[DataFrame], DataFrame]) -> int | None:
        """Log what ``change`` does to the newest state; the event's number, if it does anything.

        The rows it concerns come to the driver, a few for each load.
        """
        while True:
            base, numbers = self._known()
            number = max([base or 0, *numbers]) + 1
            found = differences(self._state(base, numbers), change).collect()
            if not found:
                return None
            lines = [json.dumps({"number": number, **row.asDict()}) for row in found]
            if fs.put_new(self.spark, self._event(number), "\n".join(lines) + "\n"):
                if len(numbers) + 1 >= self.fold_after:
                    self.fold()
                return number

    def fold(self, keep: int = 3) -> int | None:
        """Make the newest state a base; remove bases, and events, that none of ``keep`` needs.

        Whoever claims a number folds it. One that dies over it leaves the old
        base and its events as they were.
        """
        base, numbers = self._known()
        if not numbers:
            return None
        if not fs.put_new(self.spark, f"{self.events}/{numbers[-1]:015d}.folded", ""):
            return None
        self.publish(self._state(base, numbers), numbers[-1])
        self.base.prune(keep)
        oldest = self.base.complete()[0]
        for number in self._numbers():
            if number <= oldest:
                fs.remove(self.spark, self._event(number))
                fs.remove(self.spark, f"{self.events}/{number:015d}.folded")
        return numbers[-1]
