"""Delimited text extracts with escapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text as X
from tidemark.functions.types import strict_cast


def parse_lines(lines: DataFrame, schema: T.StructType, sep: str, null_value: str,
                escapes: dict[str, str] = X.LINE_ESCAPES, on_bad_row: str = "fail") -> DataFrame:
    """Typed rows from a ``value`` column of lines.

    ``on_bad_row="fail"`` stops at a line with the wrong number of fields;
    ``"pad"`` reads missing trailing fields as NULL and stops at extra ones only.
    """
    if on_bad_row not in ("fail", "pad"):
        raise ValueError(f"unknown on_bad_row {on_bad_row!r}")
    parts = lines.select(X.split_fields(F.col("value"), sep).alias("parts"))
    # checked in the projection: as a filter the split would move below and run again
    size = F.size("parts")
    bad = size != len(schema) if on_bad_row == "fail" else size > len(schema)
    wrong = F.concat(F.lit(f"expected {len(schema)} fields, got "), size.cast("string"))
    parts = parts.select(F.when(bad, F.raise_error(wrong).cast("array<string>"))
                         .otherwise(F.col("parts")).alias("parts"))

    def value(i: int, f: T.StructField) -> Column:
        raw = F.get("parts", F.lit(i))
        if X.is_plain(f.dataType, sep):
            text = F.when(raw != null_value, raw)
        else:
            text = X.unescape(raw, sep, null_value, escapes)
        return strict_cast(text, f.dataType, f.name).alias(f.name)

    return parts.select(*[value(i, f) for i, f in enumerate(schema.fields)])


def read_text(spark: SparkSession, path: str, schema: T.StructType, *, sep: str,
              null_value: str, escapes: dict[str, str] = X.LINE_ESCAPES,
              on_bad_row: str = "fail") -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return parse_lines(lines, schema, sep, null_value, escapes, on_bad_row)


def read_sub(spark: SparkSession, path: str, schema: T.StructType, **kw) -> DataFrame:
    """Extracts for table storage: ``\\x1A`` between fields, empty is NULL."""
    return read_text(spark, path, schema, sep=X.SUB, null_value="", **kw)


def read_soh(spark: SparkSession, path: str, schema: T.StructType, **kw) -> DataFrame:
    """Extracts between databases: ``\\x01`` between fields, ``\\N`` is NULL."""
    return read_text(spark, path, schema, sep=X.SOH, null_value=X.NULL_MARK,
                     escapes=X.COPY_ESCAPES, **kw)
