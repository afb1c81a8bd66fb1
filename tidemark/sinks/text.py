"""Delimited exports: the inverse of the text and change-file readers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as X


def write_text(df: DataFrame, path: str, *, sep: str, null_value: str,
               escapes: dict[str, str] = X.LINE_ESCAPES, mode: str = "overwrite") -> None:
    lines = df.select(X.join_fields(df.schema, sep, null_value, escapes).alias("value"))
    lines.write.mode(mode).option("lineSep", "\n").text(path)


def write_sub(df: DataFrame, path: str, **kw) -> None:
    """For table storage; empty text and NULL are the same there."""
    write_text(df, path, sep=X.SUB, null_value="", **kw)


def write_soh(df: DataFrame, path: str, **kw) -> None:
    write_text(df, path, sep=X.SOH, null_value=X.NULL_MARK, escapes=X.COPY_ESCAPES, **kw)


def write_change_csv(df: DataFrame, path: str, *, delimiter: str = "|",
                     mode: str = "overwrite") -> None:
    """Rows in change-file form; NULL is ``\\N``, empty text an empty field."""
    rows = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(X.NULL_MARK)).alias(c)
                       for c in df.columns])
    (rows.write.mode(mode).option("sep", delimiter).option("quote", '"').option("escape", "\\")
     .option("emptyValue", "").option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(path))
