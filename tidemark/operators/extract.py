"""Watermark windows over a source table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.operators.columns import ts_literal, with_audit_columns

Bound = datetime | str | None


def window_filter(df: DataFrame, column: str, lower: Bound, upper: Bound) -> DataFrame:
    """Rows with ``lower < column <= upper``; a missing bound is open.

    Bounds become literals of the column's own type, so the comparison reaches
    the Parquet, ORC or JDBC scan as a pushed filter.
    """
    dtype = df.schema[column].dataType.simpleString()
    if lower is not None:
        df = df.filter(F.col(column) > ts_literal(lower, dtype))
    if upper is not None:
        df = df.filter(F.col(column) <= ts_literal(upper, dtype))
    return df


def live_only(df: DataFrame, flag: str = S.DELETED_FLAG) -> DataFrame:
    return df.filter(F.col(flag) == 0)


def extract(df: DataFrame, load_type: str, column: str | None, *, now: Bound,
            last_run: Bound = None, second_last_run: Bound = None,
            overlap: bool | None = None, flag: str = S.DELETED_FLAG,
            load_ts: datetime | str | None = None, updated_by: str = "tidemark") -> DataFrame:
    """Rows due for one load, with audit columns.

    FULL takes everything. INCREMENTAL starts one run earlier than needed
    (``second_last_run``), which the keyed merge absorbs. APPEND_ONLY takes live
    rows after ``last_run``: with the earlier bound every row would be appended
    twice, so that form has to be asked for with ``overlap=True``.
    """
    S.check_load_type(load_type)
    if load_type != S.FULL:
        if overlap is None:
            overlap = load_type == S.INCREMENTAL
        df = window_filter(df, column, second_last_run if overlap else last_run, now)
        if load_type == S.APPEND_ONLY:
            df = live_only(df, flag)
    return with_audit_columns(df, load_ts if load_ts is not None else now, updated_by)
