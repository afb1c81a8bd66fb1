"""The control table: which pairs to load, from where on, and how it went."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.operators.columns import ts_literal

# Route names as control rows carry them.
CHANGES_TO_DB = "SRC2GP"
CHANGES_TO_DB_STRICT = "SRC2RDS"
DB_TO_TABLE = "GP2HDFS"
STAGED_TO_TABLE = "HDFS2MIR"
TABLE_TO_TABLE = "MIR2"
DB_FILE_TO_DB = "GP2Postgres"

SCHEMA = """
    id int, load_group_id int,
    source_schemaname string, source_tablename string,
    target_schemaname string, target_tablename string,
    data_path string, load_type string, incremental_column string, join_columns string,
    last_run_time timestamp_ntz, second_last_run_time timestamp_ntz,
    hvr_last_processed_value timestamp_ntz,
    status_flag string, load_status_cd string, log_mode string,
    is_partitioned boolean, s3_backed boolean, archived_enabled boolean,
    first_partitioned_column string, second_partitioned_column string,
    partition_column_transformation string,
    distribution_columns string, dist_col_transformation string, custom_sql string
"""


def is_mirror(route: str) -> bool:
    return TABLE_TO_TABLE in route and route != STAGED_TO_TABLE


def due(control: DataFrame, route: str, schema: str, load_type: str, *,
        group: int | None = None, tables: Sequence[str] | None = None) -> DataFrame:
    """Active rows of a route, schema and load type.

    Mirror routes are picked by their target's name, others by their source's.
    Database-to-table rows also need something new at the source.
    """
    side = "target" if is_mirror(route) else "source"
    rows = control.filter((F.col("status_flag") == "Y") & (F.col("data_path") == route)
                          & (F.col("load_type") == load_type)
                          & (F.col(f"{side}_schemaname") == schema))
    if group is not None:
        rows = rows.filter(F.col("load_group_id") == group)
    if tables is not None:
        rows = rows.filter(F.col(f"{side}_tablename").isin(list(tables)))
    if DB_TO_TABLE in route:
        rows = rows.filter((F.col("hvr_last_processed_value") > F.col("last_run_time"))
                           | F.col("last_run_time").isNull())
    return rows


def sync_pairs(control: DataFrame, route: str, target: str | None = None) -> DataFrame:
    """Distinct source/target pairs of a route, by full name."""
    rows = control.filter((F.col("status_flag") == "Y") & (F.col("data_path") == route))
    rows = rows.select(
        F.concat_ws(".", "source_schemaname", "source_tablename").alias("source_table"),
        F.concat_ws(".", "target_schemaname", "target_tablename").alias("target_table"),
        "incremental_column", "second_last_run_time", "s3_backed", "load_type")
    if target is not None:
        rows = rows.filter(F.col("target_table") == target)
    return rows.distinct()


def _same_load(schema: str, table: str, route: str) -> Column:
    """The control rows one load stands for."""
    where = F.col("target_schemaname") == schema
    if route == STAGED_TO_TABLE:
        return (where & F.col("target_tablename").isin(table, f"{table}_ext")
                & F.col("data_path").isin(DB_TO_TABLE, STAGED_TO_TABLE))
    return where & (F.col("target_tablename") == table) & (F.col("data_path") == route)


def _update(control: DataFrame, where: Column, values: dict[str, Column]) -> DataFrame:
    return control.withColumns({c: F.when(where, v).otherwise(F.col(c))
                                for c, v in values.items()})


def set_status(control: DataFrame, schema: str, table: str, route: str, code: str) -> DataFrame:
    """Running, completed or error, on every row the load stands for."""
    return _update(control, _same_load(schema, table, route), {"load_status_cd": F.lit(code)})


def advance(control: DataFrame, schema: str, table: str, route: str, window_end) -> DataFrame:
    """After a successful load: the window's end is the new watermark, the old
    one becomes the second-last."""
    return _update(control, _same_load(schema, table, route), {
        "second_last_run_time": F.col("last_run_time"),
        "last_run_time": ts_literal(window_end),
        "status_flag": F.lit("Y"),
        "load_status_cd": F.lit(S.STATUS_COMPLETED),
    })


def changes_applied(control: DataFrame, schema: str, table: str, route: str,
                    window_end) -> DataFrame:
    """After a change apply: advance this route and tell the next one there is news.

    The null-safe route signals the database-to-table route; the strict one has
    no successor and marks its own row.
    """
    at = ts_literal(window_end)
    here = ((F.col("source_schemaname") == schema) & (F.col("source_tablename") == table)
            & (F.col("data_path") == route))
    if route == CHANGES_TO_DB_STRICT:
        return _update(control, here, {"last_run_time": at, "hvr_last_processed_value": at})
    control = _update(control, here, {"last_run_time": at})
    following = ((F.col("source_schemaname") == schema) & (F.col("source_tablename") == table)
                 & (F.col("data_path") == DB_TO_TABLE))
    return _update(control, following, {"hvr_last_processed_value": at})


def file_loaded(control: DataFrame, row_id: int, route: str, window_end) -> DataFrame:
    """After a file or cross-database load: advance the one row by its id."""
    here = (F.col("id") == row_id) & (F.col("data_path") == route)
    return _update(control, here, {"last_run_time": ts_literal(window_end)})


def with_connections(applications: DataFrame, connections: DataFrame) -> DataFrame:
    """Application rows with the details of their source and target connection.

    ``connections`` holds id, host, port and dbname; it is joined twice.
    """
    def side(name: str) -> DataFrame:
        return connections.select(F.col("id").alias(f"{name}_bu_id"),
                                  *[F.col(c).alias(f"{name}_{c}")
                                    for c in ("host", "port", "dbname")])

    return (applications.join(side("source"), "source_bu_id")
            .join(side("target"), "target_bu_id"))
