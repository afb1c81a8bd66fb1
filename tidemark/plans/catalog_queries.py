"""Catalog, control and audit rows.

The rows stand in for a database's catalog and for control tables; they are
derived from whole test tables so that the work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.control import audit as A
from tidemark.control import events as CE
from tidemark.control import table as CT
from tidemark.functions import types as TY
from tidemark.plans import inputs as I
from tidemark.plans.registry import query, table
from tidemark.session import scratch
from tidemark.sources import tables as ST

# A spread of source types, one per remainder of p_size.
TYPES = ["numeric", "numeric", "double precision", "character varying", "character", "text",
         "name", "timestamp without time zone", "bigint", "integer", "smallint", "date",
         "ARRAY", "boolean", "real", "timestamp with time zone", "json", "bytea"]

# Columns per stand-in table: a table's column list does not grow with the data.
WIDTH = 40


def metadata(spark: SparkSession, sf: str) -> DataFrame:
    kinds = F.array(*[F.lit(t) for t in TYPES])
    kind = F.get(kinds, (F.col("p_size") % len(TYPES)).cast("int"))
    numeric = kind == "numeric"
    return table(spark, sf, "part").select(
        F.concat(F.lit("s"), F.expr(f"p_partkey div {WIDTH * 10}").cast("string"))
        .alias("table_schema"),
        F.concat(F.lit("t"), F.expr(f"p_partkey div {WIDTH}").cast("string"))
        .alias("table_name"),
        F.concat(F.replace("p_name", F.lit(" "), F.lit("$")), F.lit("_"),
                 F.col("p_partkey").cast("string")).alias("column_name"),
        (F.col("p_partkey") % WIDTH + 1).cast("int").alias("ordinal_position"), kind.alias("data_type"),
        F.when(numeric & (F.col("p_retailprice") < 1000), F.col("p_size") % 40 + 1)
        .alias("numeric_precision"),
        F.when(numeric & (F.col("p_retailprice") < 1000), F.col("p_size") % 2)
        .alias("numeric_scale"))


_TYPE_LIST = ", ".join(f"'{t}'" for t in TYPES)
METADATA_SQL = f"""md AS (
  SELECT 's' || (p_partkey // {WIDTH * 10}) AS table_schema, 't' || (p_partkey // {WIDTH}) AS table_name,
    replace(p_name, ' ', '$') || '_' || p_partkey AS column_name,
    CAST(p_partkey % {WIDTH} + 1 AS INTEGER) AS ordinal_position, data_type,
    CASE WHEN data_type = 'numeric' AND p_retailprice < 1000 THEN p_size % 40 + 1 END
      AS numeric_precision,
    CASE WHEN data_type = 'numeric' AND p_retailprice < 1000 THEN p_size % 2 END AS numeric_scale,
    p_size, p_retailprice
  FROM (SELECT *, ([{_TYPE_LIST}])[CAST(p_size % {len(TYPES)} + 1 AS INTEGER)] AS data_type
        FROM part))"""
_COMPAT_SQL = """CASE
    WHEN data_type = 'numeric' AND numeric_precision IS NOT NULL AND numeric_scale = 0 THEN 'bigint'
    WHEN data_type IN ('numeric', 'double precision') OR numeric_scale > 0 THEN 'double'
    WHEN data_type IN ('character varying', 'character', 'text', 'name') THEN 'string'
    WHEN data_type = 'timestamp without time zone' THEN 'timestamp_ntz'
    WHEN data_type = 'bigint' THEN 'bigint' WHEN data_type = 'integer' THEN 'int'
    WHEN data_type = 'smallint' THEN 'smallint' WHEN data_type = 'date' THEN 'date'
    WHEN data_type = 'ARRAY' THEN 'array<string>' ELSE 'string' END"""
_EXACT_SQL = """CASE
    WHEN data_type = 'numeric' AND numeric_precision <= 38
      THEN 'decimal(' || numeric_precision || ',' || numeric_scale || ')'
    WHEN data_type = 'numeric' THEN 'decimal(38,18)'
    WHEN data_type = 'double precision' THEN 'double'
    WHEN data_type IN ('character varying', 'character', 'text', 'name') THEN 'string'
    WHEN data_type = 'timestamp without time zone' THEN 'timestamp_ntz'
    WHEN data_type = 'timestamp with time zone' THEN 'timestamp'
    WHEN data_type = 'bigint' THEN 'bigint' WHEN data_type = 'integer' THEN 'int'
    WHEN data_type = 'smallint' THEN 'smallint' WHEN data_type = 'date' THEN 'date'
    WHEN data_type = 'boolean' THEN 'boolean' WHEN data_type = 'real' THEN 'float'
    WHEN data_type = 'ARRAY' THEN 'array<string>' ELSE 'string' END"""
_MAPPED = "table_name, column_name, replace(column_name, '$', '_') AS target_column, data_type"


def _mapped(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    return TY.map_types(metadata(spark, sf), mode).select(
        "table_name", "column_name", "target_column", "data_type", "spark_type")


@query("type_map", f"WITH {METADATA_SQL} SELECT {_MAPPED}, {_EXACT_SQL} AS spark_type FROM md")
def type_map(spark: SparkSession, sf: str) -> DataFrame:
    return _mapped(spark, sf, TY.EXACT)


@query("type_map_compat",
       f"WITH {METADATA_SQL} SELECT {_MAPPED}, {_COMPAT_SQL} AS spark_type FROM md")
def type_map_compat(spark: SparkSession, sf: str) -> DataFrame:
    return _mapped(spark, sf, TY.COMPAT)


@query("column_lists", f"""WITH {METADATA_SQL}
  SELECT table_schema, table_name,
    string_agg('`' || replace(column_name, '$', '_') || '` ' || {_COMPAT_SQL}, ', '
               ORDER BY ordinal_position) AS column_list,
    count(*) AS column_count
  FROM md GROUP BY table_schema, table_name""")
def column_lists(spark: SparkSession, sf: str) -> DataFrame:
    return TY.column_lists(metadata(spark, sf), TY.COMPAT)


@query("schema_drift", f"""WITH {METADATA_SQL},
  s AS (SELECT * FROM md WHERE numeric_precision IS NULL OR numeric_precision < 35),
  t AS (SELECT table_schema, table_name, column_name,
               CASE WHEN data_type = 'integer' THEN 'bigint' ELSE data_type END AS data_type
        FROM md WHERE data_type <> 'json')
  SELECT coalesce(s.table_schema, t.table_schema) AS table_schema,
    coalesce(s.table_name, t.table_name) AS table_name,
    coalesce(s.column_name, t.column_name) AS column_name,
    s.data_type AS source_type, t.data_type AS target_type,
    CASE WHEN t.data_type IS NULL THEN 'added' WHEN s.data_type IS NULL THEN 'removed'
         ELSE 'retyped' END AS change
  FROM s FULL JOIN t ON s.table_schema = t.table_schema AND s.table_name = t.table_name
    AND s.column_name = t.column_name
  WHERE s.data_type IS DISTINCT FROM t.data_type""")
def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    rows = metadata(spark, sf)
    source = rows.filter(F.col("numeric_precision").isNull() | (F.col("numeric_precision") < 35))
    target = rows.filter(F.col("data_type") != "json").withColumn(
        "data_type", F.when(F.col("data_type") == "integer", "bigint")
        .otherwise(F.col("data_type")))
    return TY.schema_drift(source, target)


@query("catalog_columns", f"""WITH {METADATA_SQL}
  SELECT table_schema, table_name, ordinal_position, column_name FROM md
  ORDER BY table_schema, table_name, ordinal_position""")
def catalog_columns(spark: SparkSession, sf: str) -> DataFrame:
    return ST.ordered_columns(metadata(spark, sf))


def _partition_keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("tbl_id"),
        F.concat("l_returnflag", "l_linestatus").alias("pkey_name"))


_KEYS_SQL = """pk AS (SELECT DISTINCT l_partkey AS tbl_id, l_returnflag || l_linestatus AS pkey_name
                      FROM lineitem),
  pks AS (SELECT tbl_id, count(*) AS partition_col_cnt,
                 string_agg(pkey_name, ',' ORDER BY pkey_name) AS partition_cols
          FROM pk GROUP BY tbl_id)"""


@query("partition_key_summary", f"WITH {_KEYS_SQL} SELECT * FROM pks")
def partition_key_summary(spark: SparkSession, sf: str) -> DataFrame:
    return ST.partition_key_summary(_partition_keys(spark, sf))


@query("table_facts", f"""WITH {_KEYS_SQL}
  SELECT n_name || '.' || p_name AS full_table_name, n_name AS schema_name, p_name AS table_name,
    CASE WHEN p_type LIKE 'S%' THEN 'VIEW' WHEN p_type LIKE 'E%' THEN 'TABLE' ELSE p_type END
      AS table_type,
    coalesce(partition_col_cnt, 0) AS partition_col_cnt, partition_cols
  FROM part JOIN nation ON p_size % 25 = n_nationkey LEFT JOIN pks ON p_partkey = pks.tbl_id""")
def table_facts(spark: SparkSession, sf: str) -> DataFrame:
    kind = (F.when(F.col("p_type").like("S%"), "VIRTUAL_VIEW")
            .when(F.col("p_type").like("E%"), "EXTERNAL_TABLE").otherwise(F.col("p_type")))
    tables = table(spark, sf, "part").select(
        F.col("p_partkey").alias("tbl_id"), (F.col("p_size") % 25).alias("db_id"),
        F.col("p_name").alias("tbl_name"), kind.alias("tbl_type"))
    databases = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("db_id"), F.col("n_name").alias("db_name"))
    return ST.table_facts(tables, databases, _partition_keys(spark, sf))


ROUTES = {"1-URGENT": CT.DB_TO_TABLE, "2-HIGH": CT.CHANGES_TO_DB, "3-MEDIUM": CT.STAGED_TO_TABLE,
          "4-NOT SPECIFIED": "MIR2HIVE", "5-LOW": CT.CHANGES_TO_DB_STRICT}
_SOURCE_NEWS = "1998-01-01 00:00:00"


def control_rows(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("o_totalprice")
    route = F.lit(None).cast("string")
    for priority, name in ROUTES.items():
        route = F.when(F.col("o_orderpriority") == priority, name).otherwise(route)
    schema = F.lower("o_orderstatus")
    name = F.concat(F.lit("t"), F.col("o_custkey").cast("string"))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 10).alias("load_group_id"),
        schema.alias("source_schemaname"), name.alias("source_tablename"),
        F.concat(F.lit("m_"), schema).alias("target_schemaname"), name.alias("target_tablename"),
        route.alias("data_path"),
        F.when(price < 150000, "FULL").when(price < 250000, "APPEND_ONLY")
        .otherwise("INCREMENTAL").alias("load_type"),
        F.lit("ts").alias("incremental_column"),
        F.when(price >= 50000, F.col("o_orderdate")).alias("last_run_time"),
        F.expr("o_orderdate - interval 1 day").alias("second_last_run_time"),
        F.lit(_SOURCE_NEWS).cast("timestamp_ntz").alias("hvr_last_processed_value"),
        F.when(price > 400000, "N").otherwise("Y").alias("status_flag"),
        F.lit("R").alias("load_status_cd"), (price > 300000).alias("s3_backed"))


_ROUTE_SQL = "CASE o_orderpriority " + " ".join(
    f"WHEN '{p}' THEN '{r}'" for p, r in ROUTES.items()) + " END"
CONTROL_SQL = f"""ctl AS (
  SELECT o_orderkey AS id, o_custkey % 10 AS load_group_id,
    lower(o_orderstatus) AS source_schemaname, 't' || o_custkey AS source_tablename,
    'm_' || lower(o_orderstatus) AS target_schemaname, 't' || o_custkey AS target_tablename,
    {_ROUTE_SQL} AS data_path,
    CASE WHEN o_totalprice < 150000 THEN 'FULL' WHEN o_totalprice < 250000 THEN 'APPEND_ONLY'
         ELSE 'INCREMENTAL' END AS load_type, 'ts' AS incremental_column,
    CASE WHEN o_totalprice >= 50000 THEN o_orderdate END AS last_run_time,
    o_orderdate - INTERVAL 1 DAY AS second_last_run_time,
    TIMESTAMP '{_SOURCE_NEWS}' AS hvr_last_processed_value,
    CASE WHEN o_totalprice > 400000 THEN 'N' ELSE 'Y' END AS status_flag,
    'R' AS load_status_cd, o_totalprice > 300000 AS s3_backed
  FROM orders)"""


@query("control_due", f"""WITH {CONTROL_SQL}
  SELECT id, data_path, load_type, last_run_time FROM ctl WHERE status_flag = 'Y' AND (
    (data_path = 'GP2HDFS' AND load_type = 'FULL' AND source_schemaname = 'f'
       AND (hvr_last_processed_value > last_run_time OR last_run_time IS NULL))
    OR (data_path = 'MIR2HIVE' AND load_type = 'INCREMENTAL' AND target_schemaname = 'm_o'
       AND load_group_id = 3)
    OR (data_path = 'SRC2GP' AND load_type = 'APPEND_ONLY' AND source_schemaname = 'p'
       AND source_tablename IN ('t1', 't2', 't3', 't5', 't8', 't13', 't21', 't34')))""")
def control_due(spark: SparkSession, sf: str) -> DataFrame:
    control = control_rows(spark, sf)
    due = (CT.due(control, CT.DB_TO_TABLE, "f", "FULL")
           .unionByName(CT.due(control, "MIR2HIVE", "m_o", "INCREMENTAL", group=3))
           .unionByName(CT.due(control, CT.CHANGES_TO_DB, "p", "APPEND_ONLY",
                               tables=["t1", "t2", "t3", "t5", "t8", "t13", "t21", "t34"])))
    return due.select("id", "data_path", "load_type", "last_run_time")


@query("control_pairs", f"""WITH {CONTROL_SQL}
  SELECT DISTINCT source_schemaname || '.' || source_tablename AS source_table,
    target_schemaname || '.' || target_tablename AS target_table, incremental_column,
    second_last_run_time, s3_backed, load_type
  FROM ctl WHERE status_flag = 'Y' AND data_path = 'HDFS2MIR'""")
def control_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return CT.sync_pairs(control_rows(spark, sf), CT.STAGED_TO_TABLE)


_STATE = ["id", "data_path", "last_run_time", "second_last_run_time", "hvr_last_processed_value",
          "status_flag", "load_status_cd"]


@query("control_advance", f"""WITH {CONTROL_SQL},
  hit AS (SELECT *, target_schemaname = 'm_f' AND target_tablename IN ('t10', 't10_ext')
             AND data_path IN ('GP2HDFS', 'HDFS2MIR') AS h FROM ctl)
  SELECT id, data_path,
    CASE WHEN h THEN TIMESTAMP '{I.LOAD_STAMP}' ELSE last_run_time END AS last_run_time,
    CASE WHEN h THEN last_run_time ELSE second_last_run_time END AS second_last_run_time,
    hvr_last_processed_value, CASE WHEN h THEN 'Y' ELSE status_flag END AS status_flag,
    CASE WHEN h THEN 'C' ELSE load_status_cd END AS load_status_cd FROM hit""")
def control_advance(spark: SparkSession, sf: str) -> DataFrame:
    return CT.advance(control_rows(spark, sf), "m_f", "t10", CT.STAGED_TO_TABLE,
                      I.LOAD_STAMP).select(*_STATE)


@query("control_status", f"""WITH {CONTROL_SQL}
  SELECT id, data_path, last_run_time, second_last_run_time, hvr_last_processed_value, status_flag,
    CASE WHEN target_schemaname = 'm_o' AND target_tablename = 't7' AND data_path = 'SRC2GP'
         THEN 'E' ELSE load_status_cd END AS load_status_cd FROM ctl""")
def control_status(spark: SparkSession, sf: str) -> DataFrame:
    return CT.set_status(control_rows(spark, sf), "m_o", "t7", CT.CHANGES_TO_DB,
                         "E").select(*_STATE)


@query("control_hwm", f"""WITH {CONTROL_SQL},
  hit AS (SELECT *, source_schemaname = 'f' AND source_tablename = 't25' AS h FROM ctl)
  SELECT id, data_path,
    CASE WHEN h AND data_path = 'SRC2GP' THEN TIMESTAMP '{I.LOAD_STAMP}' ELSE last_run_time END
      AS last_run_time, second_last_run_time,
    CASE WHEN h AND data_path = 'GP2HDFS' THEN TIMESTAMP '{I.LOAD_STAMP}'
         ELSE hvr_last_processed_value END AS hvr_last_processed_value,
    status_flag, load_status_cd FROM hit""")
def control_hwm(spark: SparkSession, sf: str) -> DataFrame:
    return CT.changes_applied(control_rows(spark, sf), "f", "t25", CT.CHANGES_TO_DB,
                              I.LOAD_STAMP).select(*_STATE)


def control_events(spark: SparkSession, sf: str) -> DataFrame:
    """An event sets a watermark, a flag or a status of the row with the user's number."""
    kind, moment = F.col("event_type"), F.col("ts").cast("string")
    column = (F.when(kind == "purchase", "last_run_time").when(kind == "signup", "status_flag")
              .when(kind == "error", "load_status_cd").otherwise("hvr_last_processed_value"))
    value = (F.when(kind == "signup", "N").when(kind == "error", "E")
             .when(F.col("event_id") % 7 != 0, moment))
    return table(spark, sf, "events").select(
        F.col("event_id").alias("number"), F.col("user_id").cast("int").alias("id"),
        F.lit(CT.CHANGES_TO_DB).alias("data_path"), column.alias("column"), value.alias("value"))


@query("control_log", f"""WITH {CONTROL_SQL},
  newest AS (
    SELECT user_id, event_type, event_id, ts,
      CASE event_type WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 WHEN 'error' THEN 3 ELSE 4 END
        AS kind FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, kind ORDER BY event_id DESC) = 1),
  put AS (SELECT *, CASE WHEN event_id % 7 <> 0 THEN ts END AS moment FROM newest)
  SELECT id, 'SRC2GP' AS data_path,
    CASE WHEN a.kind IS NULL THEN last_run_time ELSE a.moment END AS last_run_time,
    second_last_run_time,
    CASE WHEN d.kind IS NULL THEN hvr_last_processed_value ELSE d.moment END
      AS hvr_last_processed_value,
    CASE WHEN b.kind IS NULL THEN status_flag ELSE 'N' END AS status_flag,
    CASE WHEN c.kind IS NULL THEN load_status_cd ELSE 'E' END AS load_status_cd
  FROM ctl LEFT JOIN put a ON a.user_id = id AND a.kind = 1
    LEFT JOIN put b ON b.user_id = id AND b.kind = 2
    LEFT JOIN put c ON c.user_id = id AND c.kind = 3
    LEFT JOIN put d ON d.user_id = id AND d.kind = 4""")
def control_log(spark: SparkSession, sf: str) -> DataFrame:
    control = control_rows(spark, sf).withColumns({
        "id": F.col("id").cast("int"), "data_path": F.lit(CT.CHANGES_TO_DB)})
    state = CE.with_events(control, control_events(spark, sf))
    return state.select(F.col("id").cast("long").alias("id"), *_STATE[1:])


@query("control_connections", """
  WITH conn AS (SELECT n_nationkey AS id, n_name AS host, CAST(5432 AS INTEGER) AS port,
                       r_name AS dbname FROM nation JOIN region ON n_regionkey = r_regionkey)
  SELECT a.c_custkey AS id, a.c_name AS source_tablename, a.c_mktsegment AS load_type,
    s.host AS source_host, s.port AS source_port, s.dbname AS source_dbname,
    t.host AS target_host, t.port AS target_port, t.dbname AS target_dbname
  FROM customer a JOIN conn s ON a.c_nationkey = s.id
    JOIN conn t ON (a.c_nationkey + 7) % 25 = t.id""")
def control_connections(spark: SparkSession, sf: str) -> DataFrame:
    applications = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("source_tablename"),
        F.col("c_mktsegment").alias("load_type"), F.col("c_nationkey").alias("source_bu_id"),
        ((F.col("c_nationkey") + 7) % 25).alias("target_bu_id"))
    connections = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("host"),
        F.lit(5432).alias("port"), F.col("r_name").alias("dbname"))
    return CT.with_connections(applications, connections).drop("source_bu_id", "target_bu_id")


def audit_rows(spark: SparkSession, sf: str) -> DataFrame:
    failed = F.col("event_type").isin("error", "purchase")
    return table(spark, sf, "events").select(
        F.col("user_id").alias("load_id"), F.col("event_id").alias("run_id"),
        F.lit("LOADER").alias("plant_name"), F.lit("SPARK").alias("technology"),
        F.concat("event_type", F.lit("_"), F.date_format("ts", "yyyyMMdd")).alias("table_name"),
        F.when(failed, A.JOB_ERROR).otherwise(A.JOB_FINISHED).alias("status"),
        F.floor(F.col("value") * 100).alias("rows_inserted"),
        F.col("props").alias("error_category"))


_AUDIT_SQL = """log AS (
  SELECT user_id AS load_id, event_id AS run_id, 'LOADER' AS plant_name, 'SPARK' AS technology,
    event_type || '_' || strftime(ts, '%Y%m%d') AS table_name,
    CASE WHEN event_type IN ('error', 'purchase') THEN 'Job Error' ELSE 'Job Finished' END
      AS status, CAST(floor(value * 100) AS BIGINT) AS rows_inserted,
    replace(props, '"', '') AS error_category
  FROM events)"""


@query("audit_append", f"WITH {_AUDIT_SQL} SELECT * FROM log")
def audit_append(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "audit")
    rows = audit_rows(spark, sf)
    A.append_events(rows.filter(F.col("status") == A.JOB_FINISHED), path)
    A.append_events(rows.filter(F.col("status") == A.JOB_ERROR), path)
    return A.read(spark, path).select("load_id", "run_id", "plant_name", "technology",
                                      "table_name", "status", "rows_inserted", "error_category")


@query("audit_errors", f"""WITH {_AUDIT_SQL}
  SELECT load_id, string_agg(table_name, ',' ORDER BY table_name) AS failed_tables,
    count(*) AS failed_count
  FROM (SELECT DISTINCT load_id, table_name FROM log WHERE status = 'Job Error') GROUP BY load_id""")
def audit_errors(spark: SparkSession, sf: str) -> DataFrame:
    return A.failed_tables(audit_rows(spark, sf))


@query("narrowing_overflows", """
  SELECT count(*) FILTER (WHERE TRY_CAST(whole AS INTEGER) IS NULL) AS whole,
    count(*) FILTER (WHERE TRY_CAST(part AS SMALLINT) IS NULL) AS part
  FROM (SELECT l_orderkey * 700001 AS whole, l_partkey * 20 AS part FROM lineitem)""")
def narrowing_overflows(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select((F.col("l_orderkey") * 700001).alias("whole"),
                                               (F.col("l_partkey") * 20).alias("part"))
    return TY.narrowing_overflows(rows, {"whole": "int", "part": "smallint"})


@query("narrow_types", """
  SELECT l_linenumber, TRY_CAST(l_orderkey * 700001 AS INTEGER) AS whole,
    TRY_CAST(l_partkey * 20 AS INTEGER) AS part FROM lineitem""")
def narrow_types(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(
        "l_linenumber", (F.col("l_orderkey") * 700001).alias("whole"),
        (F.col("l_partkey") * 20).alias("part"))
    return TY.narrow(rows, {"whole": "int", "part": "int"}, on_overflow="null")
