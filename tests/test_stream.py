"""Change files as a stream."""

import os
from datetime import datetime

import pytest
from pyspark.sql import types as T

from tidemark.sinks import orc
from tidemark.sinks.publish import Versions
from tidemark.streaming.ingest import (apply_to_partitions, apply_to_versions, ingest,
                                       target_schema)

BUSINESS = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType())])
TS = "2024-02-01 00:00:00"


def drop(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    tmp = f"{folder}/.{name}"
    with open(tmp, "w") as f:
        f.write("".join(line + "\n" for line in lines))
    os.rename(tmp, f"{folder}/{name}")


def rows(df):
    return sorted((r.id, r.v, r.hvr_is_deleted) for r in df.collect())


DROPS = [("1-t.csv", ["1|one|1|01", "2|two|1|01", "3|three|1|01"]),
         ("2-t.csv", ["1|uno|2|02", "2|gone|0|02", "3|skip|5|02"]),
         ("3-t.csv", ["1|stale|2|00", "4|four|1|03"])]
FINAL = [(1, "stale", 0), (2, "gone", 1), (4, "four", 0)]


def test_versions(spark, folder):
    root, schema = f"{folder}/target", target_schema(BUSINESS)
    write = apply_to_versions(root, schema, ["id"], TS)
    for name, lines in DROPS:
        drop(f"{folder}/in", name, *lines)
        assert ingest(spark, f"{folder}/in", "t", BUSINESS, write, f"{folder}/cp",
                      archive=f"{folder}/done") == 1
    assert ingest(spark, f"{folder}/in", "t", BUSINESS, write, f"{folder}/cp") == 0
    assert rows(Versions(spark, root).read(schema)) == FINAL
    assert len(Versions(spark, root).complete()) == 2
    assert any(f.endswith("1-t.csv") for _, _, fs in os.walk(f"{folder}/done") for f in fs)


def test_partitions_equal_versions(spark, folder):
    schema = T.StructType([*target_schema(BUSINESS).fields, T.StructField("b", T.IntegerType())])
    path = f"{folder}/target"
    orc.write(spark.createDataFrame([(1, "old", 0, None, 1), (8, "kept", 0, None, 0)], schema),
              path, partition_by=["b"])
    write = apply_to_partitions(path, schema, ["id"], ["b"], TS, derived={"b": "pmod(id, 4)"})
    for name, lines in DROPS:
        drop(f"{folder}/in", name, *lines)
        ingest(spark, f"{folder}/in", "t", BUSINESS, write, f"{folder}/cp")
    assert rows(spark.read.schema(schema).orc(path)) == sorted([*FINAL, (8, "kept", 0)])
    assert not os.path.exists(f"{path}/b=3")          # its only row was removed by op 5


def test_same_batch_again_changes_nothing(spark, folder):
    root, schema = f"{folder}/target", target_schema(BUSINESS)
    write = apply_to_versions(root, schema, ["id"], lambda batch: datetime(2024, 2, 1 + batch))
    batch = spark.createDataFrame([(1, "a", 1, "1"), (2, "b", 0, "1")],
                                  "id int, v string, op_code int, time_key string")
    write(batch, 0)
    first = rows(Versions(spark, root).read(schema))
    write(batch, 0)
    assert rows(Versions(spark, root).read(schema)) == first == [(1, "a", 0), (2, "b", 1)]
    write(batch, 1)
    write(batch, 2)
    with pytest.raises(ValueError, match="ahead of batch"):
        write(batch, 0)


def test_half_written_version_is_not_read(spark, folder):
    versions = Versions(spark, folder)
    versions.publish(spark.range(3), 1)
    versions.publish(spark.range(5), 2)
    os.remove(f"{versions.path(2)}/_SUCCESS")
    assert versions.current() == 1
    assert versions.read(spark.range(1).schema).count() == 3


def test_keep_newest_refuses_late_rows(spark, folder):
    root, schema = f"{folder}/target", target_schema(BUSINESS, keep_newest=True)
    write = apply_to_versions(root, schema, ["id"], TS, keep_newest=True)
    for name, lines in DROPS:
        drop(f"{folder}/in", name, *lines)
        ingest(spark, f"{folder}/in", "t", BUSINESS, write, f"{folder}/cp")
    got = rows(Versions(spark, root).read(schema))
    assert got == [(1, "uno", 0), (2, "gone", 1), (4, "four", 0)]
