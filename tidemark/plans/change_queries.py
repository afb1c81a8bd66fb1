"""Change-log reduction and apply, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schema as S
from tidemark.operators.changes import (apply_changes, as_target_rows, latest_changes,
                                        soft_delete_flag)
from tidemark.operators.extract import window_filter
from tidemark.operators.keyed import latest_per_key
from tidemark.plans import inputs as I
from tidemark.plans.registry import query
from tidemark.session import scratch
from tidemark.sinks import orc
from tidemark.sinks.publish import Versions, drop_files
from tidemark.streaming.ingest import (apply_to_partitions, apply_to_versions, ingest,
                                       target_schema)


@query("cdc_latest", f"""WITH {I.CHANGES_SQL}
  SELECT user_id, slot, event_id, CAST(op_code = 0 AS INTEGER) AS is_deleted
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, slot
               ORDER BY time_key DESC NULLS FIRST, event_id DESC) AS rn
        FROM chg WHERE op_code <> 5) WHERE rn = 1""")
def cdc_latest(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.changes(spark, sf).select(*I.CHANGE_KEYS, "event_id", S.OP_CODE, S.TIME_KEY)
    return (latest_changes(rows, I.CHANGE_KEYS)
            .select(*I.CHANGE_KEYS, "event_id", soft_delete_flag().alias("is_deleted")))


def _apply(spark: SparkSession, sf: str, **how) -> DataFrame:
    return apply_changes(I.change_target(spark, sf), I.change_batch(spark, sf), I.CHANGE_KEYS,
                         load_ts=I.LOAD_STAMP, **how)


_NULL_SAFE = """inc.user_id IS NOT DISTINCT FROM tgt.user_id
                AND inc.slot IS NOT DISTINCT FROM tgt.slot"""


@query("cdc_apply_incremental", f"""WITH {I.CHANGE_INPUTS_SQL}
  SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM inc WHERE {_NULL_SAFE})
  UNION ALL SELECT * FROM latest""")
def cdc_apply_incremental(spark: SparkSession, sf: str) -> DataFrame:
    return _apply(spark, sf)


@query("cdc_apply_full", f"WITH {I.CHANGE_INPUTS_SQL} SELECT * FROM latest")
def cdc_apply_full(spark: SparkSession, sf: str) -> DataFrame:
    return _apply(spark, sf, load_type=S.FULL)


@query("cdc_apply_append", f"""WITH {I.CHANGE_INPUTS_SQL}
  SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM inc WHERE {_NULL_SAFE})
  UNION ALL
  SELECT user_id, slot, event_id, event_type, value, CAST(0 AS INTEGER),
         TIMESTAMP '{I.LOAD_STAMP}' FROM inc WHERE op_code = 1""")
def cdc_apply_append(spark: SparkSession, sf: str) -> DataFrame:
    return _apply(spark, sf, load_type=S.APPEND_ONLY)


@query("cdc_apply_strict", f"""WITH {I.CHANGE_INPUTS_SQL}
  SELECT * FROM tgt WHERE NOT EXISTS (
      SELECT 1 FROM inc WHERE inc.user_id = tgt.user_id AND inc.slot = tgt.slot)
  UNION ALL SELECT * FROM latest""")
def cdc_apply_strict(spark: SparkSession, sf: str) -> DataFrame:
    return _apply(spark, sf, null_safe=False)


OVERLAP = "2024-01-08 00:00:00"


@query("cdc_keep_newest", f"""WITH {I.CHANGES_SQL},
  tgt AS (
    SELECT user_id, slot, event_id, event_type, value, time_key,
           CAST(0 AS INTEGER) AS hvr_is_deleted, TIMESTAMP '{I.TARGET_STAMP}' AS load_ts
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, slot
                 ORDER BY time_key DESC NULLS FIRST, event_id DESC) AS rn
          FROM chg WHERE ts <= TIMESTAMP '{I.TARGET_STAMP}') WHERE rn = 1),
  inc AS (
    SELECT * FROM chg c WHERE ts > TIMESTAMP '{OVERLAP}' AND NOT EXISTS (
      SELECT 1 FROM tgt t WHERE t.user_id IS NOT DISTINCT FROM c.user_id
        AND t.slot IS NOT DISTINCT FROM c.slot AND t.time_key > c.time_key)),
  latest AS (
    SELECT user_id, slot, event_id, event_type, value, time_key,
           CAST(op_code = 0 AS INTEGER) AS hvr_is_deleted, TIMESTAMP '{I.LOAD_STAMP}' AS load_ts
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, slot
                 ORDER BY time_key DESC NULLS FIRST, event_id DESC) AS rn
          FROM inc WHERE op_code <> 5) WHERE rn = 1)
  SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM inc WHERE {_NULL_SAFE})
  UNION ALL SELECT * FROM latest""")
def cdc_keep_newest(spark: SparkSession, sf: str) -> DataFrame:
    """A batch that reaches back behind the target's state: older changes are refused."""
    source = I.changes(spark, sf)
    before = window_filter(source, "ts", None, I.TARGET_STAMP)
    held = latest_per_key(before, I.CHANGE_KEYS, S.TIME_KEY).withColumn(S.OP_CODE, F.lit(2))
    target = as_target_rows(held.drop("ts"), I.TARGET_STAMP, order=None)
    batch = window_filter(source, "ts", OVERLAP, None).drop("ts")
    return apply_changes(target, batch, I.CHANGE_KEYS, load_ts=I.LOAD_STAMP, keep_newest=True)


# Days of the three drops: each holds the changes after the one before.
DROPS = [(None, "2024-01-12 00:00:00"), ("2024-01-12 00:00:00", "2024-01-24 00:00:00"),
         ("2024-01-24 00:00:00", None)]
STREAM_SQL = f"""WITH {I.CHANGES_SQL},
  drops AS (
    SELECT *, CASE WHEN ts <= TIMESTAMP '{DROPS[0][1]}' THEN 0
                   WHEN ts <= TIMESTAMP '{DROPS[1][1]}' THEN 1 ELSE 2 END AS batch FROM chg),
  last AS (
    SELECT *, max(batch) OVER (PARTITION BY user_id, slot) AS last_batch FROM drops)
  SELECT user_id, slot, event_id, event_type, value, CAST(op_code = 0 AS INTEGER)
         AS hvr_is_deleted, TIMESTAMP '{I.LOAD_STAMP}' AS load_ts
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, slot
               ORDER BY time_key DESC NULLS FIRST, event_id DESC) AS rn
        FROM last WHERE batch = last_batch AND op_code <> 5) WHERE rn = 1"""


def _business(source: DataFrame) -> T.StructType:
    return T.StructType([f for f in source.schema.fields
                         if f.name not in ("ts", S.OP_CODE, S.TIME_KEY)])


def _ingest_drops(spark: SparkSession, source: DataFrame, root: str, write) -> None:
    """Three drops arrive one after the other; each is applied when it is there."""
    for n, (lower, upper) in enumerate(DROPS):
        drop_files(window_filter(source, "ts", lower, upper).drop("ts"),
                   f"{root}/drops", "events", f"drop{n}")
        ingest(spark, f"{root}/drops", "events", _business(source), write, f"{root}/checkpoint",
               archive=f"{root}/archive")


@query("stream_cdc_apply", STREAM_SQL)
def stream_cdc_apply(spark: SparkSession, sf: str) -> DataFrame:
    source = I.changes(spark, sf)
    root = scratch(spark, "stream")
    target = target_schema(_business(source))
    _ingest_drops(spark, source, root, apply_to_versions(f"{root}/target", target, I.CHANGE_KEYS,
                                                         I.LOAD_STAMP))
    return Versions(spark, f"{root}/target").read(target)


@query("stream_cdc_apply_partitions", STREAM_SQL)
def stream_cdc_apply_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """The same drops into a target partitioned by a hash of the key."""
    source = I.changes(spark, sf)
    root = scratch(spark, "streamparts")
    target = T.StructType([*target_schema(_business(source)).fields,
                           T.StructField("bucket", T.IntegerType())])
    orc.write(spark.createDataFrame([], target), f"{root}/target", partition_by=["bucket"])
    write = apply_to_partitions(f"{root}/target", target, I.CHANGE_KEYS, ["bucket"], I.LOAD_STAMP,
                                derived={"bucket": "pmod(hash(user_id, slot), 8)"})
    _ingest_drops(spark, source, root, write)
    return spark.read.schema(target).orc(f"{root}/target").drop("bucket")


def _by_type(spark: SparkSession, sf: str, folder: str):
    """A stream target partitioned by a column that changes with the rows of a key."""
    source = I.changes(spark, sf)
    root = scratch(spark, folder)
    fields = target_schema(_business(source)).fields
    part = next(f for f in fields if f.name == "event_type")
    target = T.StructType([*(f for f in fields if f is not part), part])
    orc.write(spark.createDataFrame([], target), f"{root}/target", partition_by=["event_type"])
    write = apply_to_partitions(f"{root}/target", target, I.CHANGE_KEYS, ["event_type"],
                                I.LOAD_STAMP)
    return source, root, target, write


@query("stream_moved_partitions", STREAM_SQL)
def stream_moved_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Keys whose partition value changes between drops: no old row stays behind."""
    source, root, target, write = _by_type(spark, sf, "streammoved")
    _ingest_drops(spark, source, root, write)
    return spark.read.schema(target).orc(f"{root}/target")


@query("cdc_apply_moved_partitions", STREAM_SQL)
def cdc_apply_moved_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """The same drops handed over as batches, without files."""
    source, root, target, write = _by_type(spark, sf, "moved")
    for n, (lower, upper) in enumerate(DROPS):
        write(window_filter(source, "ts", lower, upper).drop("ts"), n)
    return spark.read.schema(target).orc(f"{root}/target")
