"""Projections: column order, names, audit and derived columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schema as S


def align(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Project ``df`` to a target's columns, by name and in the target's order.

    Columns the target does not have are dropped; a column the source lacks is
    an error.
    """
    have = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in have]
    if missing:
        raise ValueError(f"source lacks target columns: {', '.join(missing)}")
    return df.select(*[F.col(f"`{c}`").alias(c) for c in columns])


def clean_name(name: str) -> str:
    return name.replace("$", "_")


def sanitize(df: DataFrame) -> DataFrame:
    """Replace ``$`` in column names by ``_``; two names must not become one."""
    new = [clean_name(c) for c in df.columns]
    doubled = sorted({n for n in new if [m.lower() for m in new].count(n.lower()) > 1})
    if doubled:
        raise ValueError(f"column names collide after cleaning: {', '.join(doubled)}")
    return df.toDF(*new)


def drop_housekeeping(df: DataFrame, names: Sequence[str] = S.HOUSEKEEPING) -> DataFrame:
    """Business columns only. Goes by name, so column position does not matter."""
    return df.drop(*names)


def ts_literal(value: datetime | str, dtype: str = "timestamp_ntz") -> Column:
    """A typed timestamp literal that does not depend on the machine's time zone."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast(dtype)


def with_audit_columns(df: DataFrame, load_ts: datetime | str, updated_by: str = "tidemark",
                       op_code: int = S.OP_INSERT, time_key: str = "1") -> DataFrame:
    """Append who/when/op/order columns with one value for the whole load."""
    return df.withColumns({
        S.UPDATED_BY: F.lit(updated_by),
        S.UPDATED_DATE: ts_literal(load_ts),
        S.OP_CODE: F.lit(op_code).cast("int"),
        S.TIME_KEY: F.lit(time_key),
    })


def with_derived(df: DataFrame, name: str, expression: str | Column) -> DataFrame:
    """Set ``name`` from a SQL expression or Column; a column of that name is replaced.

    An alias in the expression does not matter.
    """
    return df.withColumn(name, F.expr(expression) if isinstance(expression, str) else expression)


def with_derived_all(df: DataFrame, derived: dict[str, str | Column] | None) -> DataFrame:
    for name, expression in (derived or {}).items():
        df = with_derived(df, name, expression)
    return df


def with_select_list(df: DataFrame, select_list: str, names: Sequence[str]) -> DataFrame:
    """Set ``names`` from a configured select list, one expression per name, in order.

    Control rows hold such lists for partition and distribution columns, with
    or without aliases. Columns of those names are replaced, and go last.
    """
    keep = [c for c in df.columns if c not in names]
    listed = ", ".join([f"`{c}`" for c in keep] + [select_list])
    out = df.sparkSession.sql("SELECT " + listed.replace("{", "{{").replace("}", "}}")
                              + " FROM {source}", source=df)
    if len(out.columns) != len(keep) + len(names):
        raise ValueError(f"select list {select_list!r} does not give {len(names)} columns")
    return out.toDF(*keep, *names)
