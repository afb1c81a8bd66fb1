"""Targets and incoming rows derived from the test tables, in Spark and in SQL.

Targets are the state up to one watermark and incoming rows the window after
an earlier one, so the two overlap and together cover their whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.operators.changes import as_target_rows
from tidemark.operators.columns import with_derived
from tidemark.operators.extract import window_filter
from tidemark.operators.keyed import latest_per_key
from tidemark.plans.registry import table

CHANGE_KEYS = ["user_id", "slot"]
TARGET_STAMP = "2024-01-20 00:00:00"
LOAD_STAMP = "2024-02-01 00:00:00"
SECOND_LAST_RUN = "2000-01-01 00:00:00"
LAST_RUN = "2000-06-30 00:00:00"
NOW = "2001-12-31 00:00:00"


def changes(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a change log: key (user_id, slot) where slot may be NULL."""
    number = F.substring_index(F.substring_index("props", ": ", -1), "}", 1)
    slot = F.nullif(number.cast("int"), F.lit(9))
    op = (F.when(F.col("event_type") == "purchase", S.OP_DELETE)
          .when(F.col("event_type") == "signup", S.OP_INSERT)
          .when(F.col("event_type") == "error", S.OP_IGNORED).otherwise(2))
    return table(spark, sf, "events").select(
        "user_id", slot.alias("slot"), "event_id", "event_type", "value", "ts",
        op.alias(S.OP_CODE), F.col("ts").cast("string").alias(S.TIME_KEY))


CHANGES_SQL = """chg AS (
    SELECT user_id, nullif(CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER), 9) AS slot,
           event_id, event_type, value, ts,
           CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1
                WHEN 'error' THEN 5 ELSE 2 END AS op_code,
           CAST(ts AS VARCHAR) AS time_key
    FROM events)"""


def change_target(spark: SparkSession, sf: str) -> DataFrame:
    """The target before the batch: newest row per key up to the watermark."""
    before = window_filter(changes(spark, sf), "ts", None, TARGET_STAMP)
    rows = latest_per_key(before, CHANGE_KEYS, S.TIME_KEY).withColumn(S.OP_CODE, F.lit(2))
    return as_target_rows(rows, TARGET_STAMP).drop("ts")


def change_batch(spark: SparkSession, sf: str) -> DataFrame:
    return window_filter(changes(spark, sf), "ts", TARGET_STAMP, None).drop("ts")


_TARGET_COLS = "user_id, slot, event_id, event_type, value"
CHANGE_INPUTS_SQL = f"""{CHANGES_SQL},
  tgt AS (
    SELECT {_TARGET_COLS}, CAST(0 AS INTEGER) AS hvr_is_deleted,
           TIMESTAMP '{TARGET_STAMP}' AS load_ts
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, slot
                 ORDER BY time_key DESC NULLS FIRST, event_id DESC) AS rn
          FROM chg WHERE ts <= TIMESTAMP '{TARGET_STAMP}') WHERE rn = 1),
  inc AS (SELECT * FROM chg WHERE ts > TIMESTAMP '{TARGET_STAMP}'),
  latest AS (
    SELECT {_TARGET_COLS}, CAST(op_code = 0 AS INTEGER) AS hvr_is_deleted,
           TIMESTAMP '{LOAD_STAMP}' AS load_ts
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, slot
                 ORDER BY time_key DESC NULLS FIRST, event_id DESC) AS rn
          FROM inc WHERE op_code <> 5) WHERE rn = 1)"""


def orders_target(spark: SparkSession, sf: str) -> DataFrame:
    return window_filter(table(spark, sf, "orders"), "o_orderdate", None, LAST_RUN)


def orders_incoming(spark: SparkSession, sf: str) -> DataFrame:
    rows = window_filter(table(spark, sf, "orders"), "o_orderdate", SECOND_LAST_RUN, NOW)
    return rows.withColumn("o_totalprice", F.col("o_totalprice") + 1)


def with_order_year(df: DataFrame) -> DataFrame:
    return with_derived(df, "o_year", "year(o_orderdate)")


_ORDER_REST = "o_orderdate, o_orderpriority"
ORDERS_SQL = f"""ot AS (
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {_ORDER_REST}
    FROM orders WHERE o_orderdate <= TIMESTAMP '{LAST_RUN}'),
  oi AS (
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, {_ORDER_REST}
    FROM orders WHERE o_orderdate > TIMESTAMP '{SECOND_LAST_RUN}'
                  AND o_orderdate <= TIMESTAMP '{NOW}')"""
MERGED_ORDERS_SQL = f"""WITH {ORDERS_SQL}
  SELECT * FROM ot WHERE NOT EXISTS (SELECT 1 FROM oi WHERE oi.o_orderkey = ot.o_orderkey)
  UNION ALL SELECT * FROM oi"""
