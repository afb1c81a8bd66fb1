"""Change-log drops: many CSV files per table, all columns plus op and order key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fs
from tidemark import schema as S
from tidemark.functions.text import NULL_MARK
from tidemark.functions.types import strict_cast

_BAD = "__bad_record"


def change_schema(business: T.StructType) -> T.StructType:
    """Business columns in target order, then op code and order key."""
    return T.StructType([*business.fields, T.StructField(S.OP_CODE, T.IntegerType()),
                         T.StructField(S.TIME_KEY, T.StringType())])


def drop_pattern(table: str) -> str:
    return f"*-{table}.csv"


def find_drops(spark: SparkSession, directory: str, table: str) -> list[str]:
    """Files waiting for ``table``; an empty list means there is nothing to do."""
    return fs.glob(spark, f"{directory.rstrip('/')}/{drop_pattern(table)}")


def csv_options(delimiter: str, multi_line: bool) -> dict[str, str]:
    return {"sep": delimiter, "quote": '"', "escape": "\\", "header": "false",
            "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD,
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
            "multiLine": str(multi_line).lower(),
            # a pruned parse would not notice rows of the wrong length
            "columnPruning": "false"}


def raw_schema(schema: T.StructType) -> T.StructType:
    """Every column as text: the reader's own casts cannot tell empty from NULL."""
    return T.StructType([*[T.StructField(n, T.StringType()) for n in schema.names],
                         T.StructField(_BAD, T.StringType())])


def _value(field: T.StructField) -> Column:
    raw = F.col(f"`{field.name}`")
    text = F.when(raw == NULL_MARK, None).otherwise(F.coalesce(raw, F.lit("")))
    return strict_cast(text, field.dataType, field.name).alias(field.name)


def typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Raw text rows as typed rows: ``\\N`` is NULL, an empty field is empty text.

    A row with too few or too many fields, or a value its column cannot hold,
    fails the load, as it would in the database's own loader.
    """
    # naming the first field keeps a count legal: a scan may not read the bad-row column alone
    first = F.coalesce(F.col(f"`{schema.names[0]}`"), F.lit(""))
    complaint = F.concat(F.lit("malformed change row, first field "), first, F.lit(": "),
                         F.col(_BAD))
    whole = F.when(F.col(_BAD).isNotNull(), F.raise_error(complaint).cast("boolean")
                   ).otherwise(F.lit(True))
    return raw.filter(whole).select(*[_value(f) for f in schema.fields])


def read_files(spark: SparkSession, files: Sequence[str], business: T.StructType, *,
               delimiter: str = "|", multi_line: bool = False) -> DataFrame:
    """The changes in the named files; no rows when there are none.

    ``multi_line`` is needed where quoted fields hold line breaks; such files
    cannot be split, so producers should keep each one small.
    """
    schema = change_schema(business)
    if not files:
        return spark.createDataFrame([], schema)
    raw = (spark.read.schema(raw_schema(schema)).options(**csv_options(delimiter, multi_line))
           .csv(list(files)))
    return typed(raw, schema)


def read_changes(spark: SparkSession, directory: str, table: str, business: T.StructType,
                 **how) -> DataFrame:
    """All changes of one table that wait in ``directory`` now."""
    return read_files(spark, find_drops(spark, directory, table), business, **how)


def stream_changes(spark: SparkSession, directory: str, table: str, business: T.StructType, *,
                   delimiter: str = "|", multi_line: bool = False,
                   archive: str | None = None) -> DataFrame:
    """The same rows as a stream over new files; ``archive`` takes applied ones."""
    schema = change_schema(business)
    reader = (spark.readStream.schema(raw_schema(schema))
              .options(**csv_options(delimiter, multi_line))
              .option("pathGlobFilter", drop_pattern(table)))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return typed(reader.csv(directory), schema)
