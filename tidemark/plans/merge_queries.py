"""Full, append and incremental loads, keyed deletes, extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.operators import merge as M
from tidemark.operators.extract import extract, window_filter
from tidemark.operators.keyed import delete_matching
from tidemark.operators.metrics import count_validate, merge_metrics
from tidemark.plans import inputs as I
from tidemark.plans.registry import query, table
from tidemark.session import scratch, staging
from tidemark.sinks import orc
from tidemark.sinks.files import FilesTarget
from tidemark.sinks.publish import Versions, fan_out, replace_partitions
from tidemark.sinks.text import write_soh
from tidemark.sources.tables import read_orc, snapshot
from tidemark.sources.text import read_soh

KEY = ["o_orderkey"]


@query("merge_flat", I.MERGED_ORDERS_SQL)
def merge_flat(spark: SparkSession, sf: str) -> DataFrame:
    return M.merge_flat(I.orders_target(spark, sf), I.orders_incoming(spark, sf), KEY)


@query("merge_flat_key_range", """WITH t AS (
    SELECT * FROM events WHERE ts <= TIMESTAMP '2024-01-20 00:00:00'),
  i AS (SELECT * REPLACE (value + 1 AS value) FROM events
        WHERE ts > TIMESTAMP '2024-01-18 00:00:00')
  SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.event_id = t.event_id)
  UNION ALL SELECT * FROM i""")
def merge_flat_key_range(spark: SparkSession, sf: str) -> DataFrame:
    """Event ids grow with time: earlier target rows are not joined."""
    events = table(spark, sf, "events")
    target = window_filter(events, "ts", None, "2024-01-20 00:00:00")
    incoming = window_filter(events, "ts", "2024-01-18 00:00:00", None).withColumn(
        "value", F.col("value") + 1)
    return M.merge_flat(target, incoming, ["event_id"], range_key="event_id")


@query("merge_flat_key_filter", I.MERGED_ORDERS_SQL)
def merge_flat_key_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The target's rows are tested against bits of the incoming keys."""
    return M.merge_flat(I.orders_target(spark, sf), I.orders_incoming(spark, sf), KEY,
                        key_filter=True)


@query("merge_flat_by_file", I.MERGED_ORDERS_SQL)
def merge_flat_by_file(spark: SparkSession, sf: str) -> DataFrame:
    """Only files that hold an incoming key are written anew."""
    target = FilesTarget(spark, scratch(spark, "files"), KEY)
    target.redefine(I.orders_target(spark, sf), "load1")
    with staging(spark, "incoming") as path:
        target.merge_files(snapshot(I.orders_incoming(spark, sf), path), KEY, "load2")
    return target.read()


@query("merge_flat_dedupe", f"""WITH {I.ORDERS_SQL},
  newest AS (SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST,
                                 o_orderkey DESC) AS rn FROM oi) WHERE rn = 1)
  SELECT * FROM ot WHERE NOT EXISTS (SELECT 1 FROM newest n WHERE n.o_custkey = ot.o_custkey)
  UNION ALL SELECT * FROM newest""")
def merge_flat_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    return M.merge_flat(I.orders_target(spark, sf), I.orders_incoming(spark, sf), ["o_custkey"],
                        dedupe="o_orderdate")


def _merge_into(spark: SparkSession, sf: str, partition_by: list[str], merge) -> DataFrame:
    path = scratch(spark, "merge")
    orc.write(I.with_order_year(I.orders_target(spark, sf)), path, partition_by=partition_by)
    incoming = I.with_order_year(I.orders_incoming(spark, sf))
    # the target's own column order: partition columns last
    merged = merge(read_orc(spark, path), incoming, KEY, partition_by)
    orc.overwrite_partitions(merged, path, partition_by)
    return read_orc(spark, path)


@query("merge_partitioned", f"""SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year
  FROM ({I.MERGED_ORDERS_SQL})""")
def merge_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    return _merge_into(spark, sf, ["o_year"], M.merge_partitioned)


@query("merge_partitioned_two_columns", f"""
  SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM ({I.MERGED_ORDERS_SQL})""")
def merge_partitioned_two_columns(spark: SparkSession, sf: str) -> DataFrame:
    return _merge_into(spark, sf, ["o_year", "o_orderstatus"], M.merge_partitioned)


@query("merge_partitioned_moved_keys", f"""WITH {I.ORDERS_SQL},
  moved AS (SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN 'O' ELSE 'F' END
                              AS o_orderstatus) FROM oi)
  SELECT * FROM ot WHERE NOT EXISTS (SELECT 1 FROM moved m WHERE m.o_orderkey = ot.o_orderkey)
  UNION ALL SELECT * FROM moved""")
def merge_partitioned_moved_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Incoming rows carry another partition value than the rows they replace."""
    part = ["o_orderstatus"]
    path = scratch(spark, "moved")
    orc.write(I.orders_target(spark, sf), path, partition_by=part)
    incoming = I.orders_incoming(spark, sf).withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") == "F", "O").otherwise("F"))
    target = read_orc(spark, path)
    touched = M.touched_partitions(target, incoming, KEY, part)
    merged = M.merge_partitioned_global(target, incoming, KEY, part)
    replace_partitions(merged, touched, path, part, may_empty=True)
    return read_orc(spark, path)


@query("full_load_flat", "SELECT * FROM orders")
def full_load_flat(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "full")
    source = table(spark, sf, "orders")
    orc.write(M.full(source.columns, source), path)
    return read_orc(spark, path)


@query("full_load_partitioned", """
  SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders""")
def full_load_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "fullpart")
    orc.write(I.with_order_year(table(spark, sf, "orders")), path,
              partition_by=["o_year"], sort_by=["o_orderkey"], bloom=["o_orderkey"])
    return read_orc(spark, path)


@query("append_load", f"WITH {I.ORDERS_SQL} SELECT * FROM ot UNION ALL SELECT * FROM oi")
def append_load(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "append")
    orc.write(I.orders_target(spark, sf), path)
    orc.append(I.orders_incoming(spark, sf), path)
    return read_orc(spark, path)


@query("append_load_partitioned", f"""WITH {I.ORDERS_SQL}
  SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year
  FROM (SELECT * FROM ot UNION ALL SELECT * FROM oi)""")
def append_load_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "appendpart")
    for rows in (I.orders_target(spark, sf), I.orders_incoming(spark, sf)):
        orc.append(I.with_order_year(rows), path, partition_by=["o_year"])
    return read_orc(spark, path)


def _keyed_customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").withColumn(
        "k", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")))


def _keyed_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"))


_DELETE_SQL = """WITH t AS (
    SELECT *, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END AS k FROM customer),
  b AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k FROM orders)
  SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.k %s t.k)"""


@query("delete_nullsafe", _DELETE_SQL % "IS NOT DISTINCT FROM")
def delete_nullsafe(spark: SparkSession, sf: str) -> DataFrame:
    return delete_matching(_keyed_customers(spark, sf), _keyed_orders(spark, sf), ["k"],
                           null_safe=True)


@query("delete_strict", _DELETE_SQL % "=")
def delete_strict(spark: SparkSession, sf: str) -> DataFrame:
    return delete_matching(_keyed_customers(spark, sf), _keyed_orders(spark, sf), ["k"])


@query("delete_override_key", """
  SELECT * FROM customer WHERE NOT EXISTS (
      SELECT 1 FROM orders WHERE orders.o_custkey = customer.c_custkey)""")
def delete_override_key(spark: SparkSession, sf: str) -> DataFrame:
    return delete_matching(table(spark, sf, "customer"), table(spark, sf, "orders"),
                           ["c_custkey"], incoming_keys=["o_custkey"])


_EVENTS = """event_id, ts, user_id, event_type, value, props"""
_AUDIT = f"""'tidemark' AS hive_updated_by, TIMESTAMP '{I.LOAD_STAMP}' AS hive_updated_date,
  CAST(1 AS INTEGER) AS op_code, '1' AS time_key"""
_RUNS = {"now": "2024-01-25 12:00:00", "last_run": "2024-01-20 00:00:00",
         "second_last_run": "2024-01-10 06:30:00"}


def _extract(spark: SparkSession, sf: str, load_type: str, **how) -> DataFrame:
    events = table(spark, sf, "events").withColumn(
        S.DELETED_FLAG, F.when(F.col("event_type") == "error", 1).otherwise(0))
    return extract(events, load_type, "ts", load_ts=I.LOAD_STAMP, **_RUNS, **how)


def _extract_sql(lower: str, more: str = "") -> str:
    return f"""SELECT * FROM (
      SELECT {_EVENTS}, CAST(event_type = 'error' AS INTEGER) AS hvr_is_deleted, {_AUDIT}
      FROM events) WHERE ts > TIMESTAMP '{lower}' AND ts <= TIMESTAMP '{_RUNS['now']}' {more}"""


@query("extract_overlap", _extract_sql(_RUNS["second_last_run"]))
def extract_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return _extract(spark, sf, S.INCREMENTAL)


@query("extract_exact", _extract_sql(_RUNS["last_run"]))
def extract_exact(spark: SparkSession, sf: str) -> DataFrame:
    return _extract(spark, sf, S.INCREMENTAL, overlap=False)


@query("extract_append_live", _extract_sql(_RUNS["last_run"], "AND hvr_is_deleted = 0"))
def extract_append_live(spark: SparkSession, sf: str) -> DataFrame:
    return _extract(spark, sf, S.APPEND_ONLY)


@query("extract_full", f"""SELECT {_EVENTS}, CAST(event_type = 'error' AS INTEGER)
  AS hvr_is_deleted, {_AUDIT} FROM events""")
def extract_full(spark: SparkSession, sf: str) -> DataFrame:
    return _extract(spark, sf, S.FULL)


@query("file_upsert", I.MERGED_ORDERS_SQL)
def file_upsert(spark: SparkSession, sf: str) -> DataFrame:
    incoming = I.orders_incoming(spark, sf)
    path = scratch(spark, "upsert")
    write_soh(incoming, path)
    rows = read_soh(spark, path, incoming.schema)
    return M.upsert_rows(I.orders_target(spark, sf), rows, KEY, S.INCREMENTAL)


@query("cross_sync", f"""WITH {I.ORDERS_SQL},
  t AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS k, o_orderstatus,
               o_totalprice FROM ot),
  w AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS k, o_orderstatus,
               o_totalprice FROM oi)
  SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.k IS NOT DISTINCT FROM t.k)
  UNION ALL SELECT * FROM w""")
def cross_sync(spark: SparkSession, sf: str) -> DataFrame:
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))
    target = I.orders_target(spark, sf).select(key.alias("k"), "o_orderstatus", "o_totalprice")
    window = I.orders_incoming(spark, sf).withColumn("k", key)
    return M.cross_sync(target, window, ["k"], S.INCREMENTAL)


@query("fanout_targets", """
  SELECT CAST(t.id AS INTEGER) AS target_id, orders.*
  FROM orders, (SELECT * FROM (VALUES (1), (2), (3)) v(id)) t""")
def fanout_targets(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch(spark, "fanout")
    incoming = table(spark, sf, "orders")

    def loader(target: int):
        return lambda rows: Versions(spark, f"{root}/target{target}").publish(rows, 1)

    done = fan_out(incoming, f"{root}/staged", [(t, loader(t)) for t in (1, 2, 3)])
    first, *rest = [read_orc(spark, path).select(F.lit(t).alias("target_id"), "*")
                    for t, path in done]
    for rows in rest:
        first = first.unionByName(rows)
    return first


@query("affected_partitions", """
  SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders""")
def affected_partitions(spark: SparkSession, sf: str) -> DataFrame:
    return M.affected_partitions(I.with_order_year(table(spark, sf, "orders")), ["o_year"])


@query("merge_metrics", f"""WITH {I.ORDERS_SQL}
  SELECT (SELECT count(*) FROM oi) AS rows_incoming,
    (SELECT count(*) FROM oi WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ot))
      AS rows_inserted,
    (SELECT count(*) FROM ot WHERE o_orderkey IN (SELECT o_orderkey FROM oi)) AS rows_updated,
    (SELECT count(*) FROM ot WHERE o_orderkey NOT IN (SELECT o_orderkey FROM oi)) AS rows_kept""")
def merge_metrics_query(spark: SparkSession, sf: str) -> DataFrame:
    return merge_metrics(I.orders_target(spark, sf), I.orders_incoming(spark, sf), KEY)


@query("count_validate", """SELECT a.n AS source_row_count, b.n AS target_row_count,
    a.n = b.n AS counts_match
  FROM (SELECT count(*) AS n FROM lineitem) a,
       (SELECT count(*) AS n FROM orders) b""")
def count_validate_query(spark: SparkSession, sf: str) -> DataFrame:
    return count_validate(table(spark, sf, "lineitem"), table(spark, sf, "orders"))
