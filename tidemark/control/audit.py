"""The audit log: one row per event of a load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Event columns and the status that marks a failed table.
SCHEMA = T.StructType([
    T.StructField("load_id", T.LongType()), T.StructField("run_id", T.LongType()),
    T.StructField("plant_name", T.StringType()), T.StructField("system_name", T.StringType()),
    T.StructField("job_name", T.StringType()), T.StructField("table_name", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("data_path", T.StringType()),
    T.StructField("technology", T.StringType()), T.StructField("rows_inserted", T.LongType()),
    T.StructField("rows_updated", T.LongType()), T.StructField("rows_deleted", T.LongType()),
    T.StructField("number_of_errors", T.LongType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("source_row_count", T.LongType()),
    T.StructField("target_row_count", T.LongType()),
    T.StructField("error_category", T.StringType()),
])
JOB_ERROR = "Job Error"
JOB_FINISHED = "Job Finished"


def without_quotes(text: Column) -> Column:
    return F.translate(text, "\"'", "")


def as_events(df: DataFrame) -> DataFrame:
    """``df`` in the log's columns and types; columns it lacks are NULL."""
    out = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None))
                      .cast(f.dataType).alias(f.name) for f in SCHEMA.fields])
    return out.withColumn("error_category", without_quotes(F.col("error_category")))


def append_events(events: DataFrame, path: str) -> None:
    as_events(events).write.mode("append").option("compression", "zlib").orc(path)


def append_event(spark: SparkSession, path: str, **values) -> None:
    row = tuple(values.get(name) for name in SCHEMA.names)
    append_events(spark.createDataFrame([row], SCHEMA), path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).orc(path)


def failed_tables(log: DataFrame, load_id: int | None = None) -> DataFrame:
    """Per load, the tables that failed as one sorted string and their number.

    Duplicates go on the map side, so only table names are gathered.
    """
    rows = log.filter(F.col("status") == JOB_ERROR)
    if load_id is not None:
        rows = rows.filter(F.col("load_id") == load_id)
    return (rows.select("load_id", "table_name").distinct()
            .groupBy("load_id")
            .agg(F.array_join(F.sort_array(F.collect_list("table_name")), ",")
                 .alias("failed_tables"),
                 F.count(F.lit(1)).alias("failed_count")))
