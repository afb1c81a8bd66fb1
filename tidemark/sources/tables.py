"""Tables, views and catalog facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schema as S
from tidemark.session import scratch


def read_table(spark: SparkSession, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.table(table)
    return df.select(*columns) if columns else df


def read_orc(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
             schema: T.StructType | None = None) -> DataFrame:
    """``schema`` is needed where text partition values look like numbers or dates:
    without it Spark guesses their type from the folder names."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.orc(path)
    return df.select(*columns) if columns else df


def snapshot(df: DataFrame, path: str | None = None, compression: str = "zlib") -> DataFrame:
    """Write rows (a table's or a view's) to staging and read them back.

    Later steps then work on one fixed state, see its true size when they
    choose a join, and lose no more than a file read when an executor goes.
    """
    spark = df.sparkSession
    path = path or scratch(spark, "snapshot")
    df.write.mode("overwrite").option("compression", compression).orc(path)
    return spark.read.schema(df.schema).orc(path)


def columns_of(spark: SparkSession, table: str) -> list[tuple[str, str, bool]]:
    """(name, type, is partition column) in table order."""
    return [(c.name, c.dataType, c.isPartition) for c in spark.catalog.listColumns(table)]


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [name for name, _, is_partition in columns_of(spark, table) if is_partition]


def table_kind(spark: SparkSession, table: str) -> str:
    """``VIEW`` or ``TABLE``."""
    found = spark.catalog.getTable(table)
    return "VIEW" if found.isTemporary or "VIEW" in found.tableType else "TABLE"


def bloom_columns(spark: SparkSession, table: str) -> list[str]:
    """Columns named by the table's bloom filter property, for the layout step."""
    facts = spark.sql(f"SHOW TBLPROPERTIES {table}").filter("key = 'orc.bloom.filter.columns'")
    row = facts.first()
    return [c.strip() for c in row["value"].split(",")] if row and row["value"] else []


def ordered_columns(metadata: DataFrame) -> DataFrame:
    """Catalog rows as an ordered listing: one row per column, business columns only."""
    return (metadata.filter(~F.col("column_name").isin(*S.HOUSEKEEPING))
            .select("table_schema", "table_name", "ordinal_position", "column_name")
            .orderBy("table_schema", "table_name", "ordinal_position"))


def partition_key_summary(partition_keys: DataFrame) -> DataFrame:
    """Per table: number of partition columns and their names as one string.

    Names are made distinct first, so what is gathered per table is its set of
    key names, not its rows.
    """
    return (partition_keys.select("tbl_id", "pkey_name").distinct()
            .groupBy("tbl_id")
            .agg(F.count(F.lit(1)).alias("partition_col_cnt"),
                 F.array_join(F.sort_array(F.collect_list("pkey_name")), ",")
                 .alias("partition_cols")))


def table_facts(tables: DataFrame, databases: DataFrame, partition_keys: DataFrame) -> DataFrame:
    """Full name, kind and partition columns of each table of a metastore."""
    kind = (F.when(F.col("tbl_type").like("%VIEW"), "VIEW")
            .when(F.col("tbl_type").like("%TABLE"), "TABLE").otherwise(F.col("tbl_type")))
    return (tables.join(databases, "db_id")
            .join(partition_key_summary(partition_keys), "tbl_id", "left")
            .select(F.concat_ws(".", "db_name", "tbl_name").alias("full_table_name"),
                    F.col("db_name").alias("schema_name"), F.col("tbl_name").alias("table_name"),
                    kind.alias("table_type"),
                    F.coalesce("partition_col_cnt", F.lit(0)).alias("partition_col_cnt"),
                    "partition_cols"))
