"""Text and change files, staging and publishing, layout, columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import columns as C
from tidemark.operators.extract import window_filter
from tidemark.operators.merge import merge_flat
from tidemark.plans import inputs as I
from tidemark.plans.registry import query, table
from tidemark.session import scratch
from tidemark.sinks import orc
from tidemark.sinks.publish import Versions, archive_copy, drop_files
from tidemark.sinks.text import write_soh, write_sub
from tidemark.sources.changes_csv import read_changes
from tidemark.sources.tables import read_orc, snapshot
from tidemark.sources.text import read_soh, read_sub


@query("scan_change_csv", f"""WITH {I.CHANGES_SQL}
  SELECT user_id, slot, event_id, event_type, value, ts, CAST(op_code AS INTEGER) AS op_code,
         time_key FROM chg""")
def scan_change_csv(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.changes(spark, sf)
    root = scratch(spark, "csv")
    drop_files(rows, root, "events", "20240201")
    business = T.StructType(rows.schema.fields[:-2])
    return read_changes(spark, root, "events", business)


@query("scan_text_sub", """SELECT doc_id, nullif("text", '') AS "text", nullif(lang, '') AS lang,
  nullif(source, '') AS source, n_chars FROM documents""")
def scan_text_sub(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    path = scratch(spark, "sub")
    write_sub(documents, path)
    return read_sub(spark, path, documents.schema)


@query("scan_text_soh", """SELECT doc_id, "text", CASE WHEN lang <> 'es' THEN lang END AS lang,
  source, n_chars FROM documents""")
def scan_text_soh(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").withColumn(
        "lang", F.when(F.col("lang") != "es", F.col("lang")))
    path = scratch(spark, "soh")
    write_soh(documents, path)
    return read_soh(spark, path, documents.schema)


@query("export_text_roundtrip", """SELECT conv_id, turn, role, "text" FROM conversations""")
def export_text_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    path = scratch(spark, "export")
    write_soh(rows, path)
    return read_soh(spark, path, rows.schema)


_VIEW_SQL = """SELECT o_orderkey, o_orderdate, o_totalprice, c_name, c_mktsegment
  FROM orders JOIN customer ON o_custkey = c_custkey"""


def _view(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "orders").createOrReplaceTempView("tm_orders")
    table(spark, sf, "customer").createOrReplaceTempView("tm_customer")
    return spark.sql("""SELECT o_orderkey, o_orderdate, o_totalprice, c_name, c_mktsegment
        FROM tm_orders JOIN tm_customer ON o_custkey = c_custkey""")


@query("snapshot_view", _VIEW_SQL)
def snapshot_view(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot(_view(spark, sf))


@query("mirror_view_incremental", f"""WITH v AS ({_VIEW_SQL}),
  t AS (SELECT * REPLACE (o_totalprice * 2 AS o_totalprice) FROM v
        WHERE o_orderdate <= TIMESTAMP '{I.LAST_RUN}'),
  w AS (SELECT * FROM v WHERE o_orderdate > TIMESTAMP '{I.SECOND_LAST_RUN}')
  SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.o_orderkey = t.o_orderkey)
  UNION ALL SELECT * FROM w""")
def mirror_view_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Table-to-table route: the source view is staged, then merged into the mirror."""
    view = _view(spark, sf)
    mirror = Versions(spark, scratch(spark, "mirror"))
    before = window_filter(view, "o_orderdate", None, I.LAST_RUN)
    mirror.publish(before.withColumn("o_totalprice", F.col("o_totalprice") * 2), 1)
    staged = snapshot(window_filter(view, "o_orderdate", I.SECOND_LAST_RUN, None))
    mirror.publish(merge_flat(mirror.read(view.schema), staged, ["o_orderkey"]), 2)
    return mirror.read(view.schema)


@query("staged_publish", I.MERGED_ORDERS_SQL)
def staged_publish(spark: SparkSession, sf: str) -> DataFrame:
    """A target that is merged with itself as input, version by version."""
    target = I.orders_target(spark, sf)
    versions = Versions(spark, scratch(spark, "staged"))
    versions.publish(target, 1)
    merged = merge_flat(versions.read(target.schema), I.orders_incoming(spark, sf), ["o_orderkey"])
    versions.publish(merged, 2)
    return versions.read(target.schema)


@query("archive_copy", """SELECT *, CAST(7 AS INTEGER) AS load_id FROM orders
  UNION ALL SELECT *, CAST(8 AS INTEGER) AS load_id FROM orders""")
def archive_copy_query(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    root = scratch(spark, "archive")
    archive_copy(orders, root, "orders", 7)
    return read_orc(spark, archive_copy(orders, root, "orders", 8))


@query("audit_columns", f"""SELECT *, 'loader' AS hive_updated_by,
    TIMESTAMP '{I.LOAD_STAMP}' AS hive_updated_date, CAST(1 AS INTEGER) AS op_code,
    '1' AS time_key FROM part""")
def audit_columns(spark: SparkSession, sf: str) -> DataFrame:
    return C.with_audit_columns(table(spark, sf, "part"), I.LOAD_STAMP, "loader")


@query("align_columns", "SELECT p_retailprice, p_name, p_partkey FROM part")
def align_columns(spark: SparkSession, sf: str) -> DataFrame:
    return C.align(table(spark, sf, "part"), ["p_retailprice", "p_name", "p_partkey"])


@query("sanitize_columns", """SELECT l_orderkey AS l_order_key, l_quantity AS qty_,
  l_shipdate AS _ship_date FROM lineitem""")
def sanitize_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("l_order$key"), F.col("l_quantity").alias("qty$"),
        F.col("l_shipdate").alias("$ship_date"))
    return C.sanitize(rows)


@query("drop_housekeeping", "SELECT * FROM part")
def drop_housekeeping(spark: SparkSession, sf: str) -> DataFrame:
    return C.drop_housekeeping(C.with_audit_columns(table(spark, sf, "part"), I.LOAD_STAMP))


@query("cluster_layout", """SELECT *, CAST(l_orderkey % 8 AS BIGINT) AS bucket FROM lineitem""")
def cluster_layout(spark: SparkSession, sf: str) -> DataFrame:
    rows = C.with_derived(table(spark, sf, "lineitem"), "bucket", "l_orderkey % 8 AS bucket")
    path = scratch(spark, "layout")
    orc.write(rows, path, partition_by=["l_returnflag"], distribute_by=["bucket"],
              sort_by=["l_orderkey"], bloom=["l_orderkey"])
    return read_orc(spark, path).withColumn("bucket", F.col("bucket").cast("long"))
