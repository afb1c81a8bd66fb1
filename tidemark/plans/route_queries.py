"""Whole routes: control rows, loads, targets and the counts they log."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.control import table as CT
from tidemark.plans import inputs as I
from tidemark.plans.registry import query, table
from tidemark.plans.sync import AUDITED, LoadSpec, load_changes, load_table
from tidemark.session import scratch
from tidemark.sinks.manifest import ManifestTarget

SECOND, LAST, NOW = (datetime.fromisoformat(t) for t in (I.SECOND_LAST_RUN, I.LAST_RUN, I.NOW))
YEAR = {"partition_by": ("o_year",), "partition_expr": "year(o_orderdate) as o_year"}


def order_spec(load_type: str, **more) -> LoadSpec:
    return LoadSpec(id=1, route=CT.DB_TO_TABLE, load_type=load_type, source_schema="app",
                    source_table="orders", target_schema="app", target_table="orders",
                    keys=("o_orderkey",), column="o_orderdate", last_run=LAST,
                    second_last_run=SECOND, **more)


def run_orders(spark: SparkSession, sf: str, **more) -> Iterator[tuple[ManifestTarget, str, dict]]:
    """A full load of the orders up to one watermark, then the window after an earlier one."""
    target = ManifestTarget(spark, scratch(spark, "route"))
    repriced = table(spark, sf, "orders").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    for load_id, (load_type, source, now) in enumerate([
            (S.FULL, I.orders_target(spark, sf), LAST), (S.INCREMENTAL, repriced, NOW)], 1):
        counts: dict = {}
        counts["source_row_count"] = load_table(spark, order_spec(load_type, **more), source,
                                                target, now=now, load_id=load_id, counts=counts)
        yield target, load_type, counts


def run_changes(spark: SparkSession, sf: str, **more) -> Iterator[tuple[ManifestTarget, str, dict]]:
    """The change log up to a moment, then the rest of it."""
    target = ManifestTarget(spark, scratch(spark, "changes"))
    target.create(I.change_target(spark, sf).schema, "load0", more.get("partition_by", ()))
    log = I.changes(spark, sf)
    # a source table has a watermark column beside the change columns; change files don't
    older, newer = (log.filter(test).drop("ts") for test in (
        F.col("ts") <= F.lit(I.TARGET_STAMP).cast("timestamp_ntz"),
        F.col("ts") > F.lit(I.TARGET_STAMP).cast("timestamp_ntz")))
    spec = LoadSpec(id=2, route=CT.CHANGES_TO_DB, load_type=S.INCREMENTAL, source_schema="app",
                    source_table="events", target_schema="app", target_table="events",
                    keys=tuple(I.CHANGE_KEYS), stamp=S.LOAD_STAMP, **more)
    for load_id, (rows, stamp) in enumerate([(older, I.TARGET_STAMP), (newer, I.LOAD_STAMP)], 1):
        counts: dict = {}
        counts["source_row_count"] = load_changes(
            spark, spec, rows, target, now=datetime.fromisoformat(stamp), load_id=load_id,
            counts=counts)
        yield target, spec.load_type, counts


@query("route_incremental", f"""SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year
  FROM ({I.MERGED_ORDERS_SQL})""")
def route_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The partitioned target after a full and an incremental load, by manifest."""
    *_, (target, _, _) = run_orders(spark, sf, **YEAR)
    return target.read().drop(*S.HOUSEKEEPING)


# the change route's two loads: what each puts, and whose keys it removes
_ROUTE_CHANGES_SQL = f"""{I.CHANGES_SQL},
  one AS (SELECT * FROM chg WHERE ts <= TIMESTAMP '{I.TARGET_STAMP}'),
  two AS (SELECT * FROM chg WHERE ts > TIMESTAMP '{I.TARGET_STAMP}'),
  put_one AS (SELECT * FROM one WHERE op_code <> 5 QUALIFY row_number() OVER (
    PARTITION BY user_id, slot ORDER BY time_key DESC, event_id DESC) = 1),
  put_two AS (SELECT * FROM two WHERE op_code <> 5 QUALIFY row_number() OVER (
    PARTITION BY user_id, slot ORDER BY time_key DESC, event_id DESC) = 1),
  stays AS (SELECT * FROM put_one a WHERE NOT EXISTS (SELECT 1 FROM two b
    WHERE a.user_id = b.user_id AND a.slot IS NOT DISTINCT FROM b.slot))"""


@query("route_changes", f"""WITH {_ROUTE_CHANGES_SQL}
  SELECT user_id, slot, event_id, event_type, value, CAST(op_code = 0 AS INTEGER) AS hvr_is_deleted,
    TIMESTAMP '{I.TARGET_STAMP}' AS load_ts FROM stays
  UNION ALL SELECT user_id, slot, event_id, event_type, value, CAST(op_code = 0 AS INTEGER),
    TIMESTAMP '{I.LOAD_STAMP}' FROM put_two""")
def route_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The change route by partition; rows move between partitions with their type."""
    *_, (target, _, _) = run_changes(spark, sf, partition_by=("event_type",))
    return target.read()


_ORDER_COUNTS_SQL = """
  SELECT '{name}' AS route, 1 AS load_id, (SELECT count(*) FROM ot) AS source_row_count,
    (SELECT count(*) FROM ot) AS rows_inserted, 0 AS rows_updated, 0 AS rows_deleted,
    (SELECT count(*) FROM ot) AS target_row_count
  UNION ALL SELECT '{name}', 2, (SELECT count(*) FROM oi), (SELECT count(*) FROM oi),
    (SELECT count(*) FROM ot JOIN oi USING (o_orderkey)),
    (SELECT count(*) FROM ot JOIN oi USING (o_orderkey)),
    (SELECT count(*) FROM ot) - (SELECT count(*) FROM ot JOIN oi USING (o_orderkey))
      + (SELECT count(*) FROM oi)"""
_CHANGE_COUNTS_SQL = """
  SELECT '{name}' AS route, 1 AS load_id, (SELECT count(*) FROM one) AS source_row_count,
    (SELECT count(*) FROM put_one) AS rows_inserted, 0 AS rows_updated, 0 AS rows_deleted,
    (SELECT count(*) FROM put_one) AS target_row_count
  UNION ALL SELECT '{name}', 2, (SELECT count(*) FROM two), (SELECT count(*) FROM put_two),
    (SELECT count(*) FROM put_one a WHERE EXISTS (SELECT 1 FROM put_two b
       WHERE a.user_id = b.user_id AND a.slot IS NOT DISTINCT FROM b.slot)),
    (SELECT count(*) FROM put_one) - (SELECT count(*) FROM stays),
    (SELECT count(*) FROM stays) + (SELECT count(*) FROM put_two)"""
_ROUTES = {"orders flat": (run_orders, {}), "orders by year": (run_orders, YEAR),
           "changes flat": (run_changes, {}),
           "changes by type": (run_changes, {"partition_by": ("event_type",)})}


@query("route_audit", f"WITH {I.ORDERS_SQL}, {_ROUTE_CHANGES_SQL}" + " UNION ALL ".join(
    (_ORDER_COUNTS_SQL if run is run_orders else _CHANGE_COUNTS_SQL).format(name=name)
    for name, (run, _) in _ROUTES.items()))
def route_audit(spark: SparkSession, sf: str) -> DataFrame:
    """What eight loads of four routes log, over whole tables.

    Routes have a target each and run beside one another; a route's loads follow in order.
    """
    names = ["source_row_count", *AUDITED, "target_row_count"]

    def logged(route: str) -> list[tuple]:
        run, more = _ROUTES[route]
        return [(route, load_id, *(counts[n] for n in names))
                for load_id, (_, _, counts) in enumerate(run(spark, sf, **more), 1)]

    with ThreadPoolExecutor(len(_ROUTES)) as pool:
        rows = [row for found in pool.map(logged, _ROUTES) for row in found]
    return spark.createDataFrame(rows, "route string, load_id int, " + ", ".join(
        f"{n} long" for n in names))
