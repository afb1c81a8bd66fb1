"""Database tables over JDBC. Connection options always come from the caller."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tidemark import schema as S
from tidemark.operators.extract import Bound, window_filter


def _text(bound) -> str:
    return bound.isoformat(sep=" ") if isinstance(bound, datetime) else str(bound)


def split_options(column: str | None, lower, upper, partitions: int) -> dict[str, str]:
    """Options that let ``partitions`` tasks read disjoint ranges of ``column``.

    The bounds place the cuts only; rows outside them still belong to the first
    and last range.
    """
    if column is None or lower is None or upper is None or partitions <= 1:
        return {}
    return {"partitionColumn": column, "lowerBound": _text(lower),
            "upperBound": _text(upper), "numPartitions": str(partitions)}


def _name(column: str) -> str:
    return '"' + column.replace('"', '""') + '"'


def key_predicates(keys: Sequence[str], partitions: int,
                   hash_of: str = "hashtext(%s)") -> list[str]:
    """Conditions that deal rows to ``partitions`` tasks by a hash of their key.

    For tables without a column whose ranges would be even. Every row meets
    exactly one of them, NULL keys included. ``hash_of`` is the database's hash
    of a text as a whole number.
    """
    if not keys or partitions <= 1:
        return []
    text = " || chr(31) || ".join(f"coalesce(CAST({_name(k)} AS text), '')" for k in keys)
    dealt = f"({hash_of % f'({text})'} & 2147483647) % {partitions}"
    return [f"{dealt} = {k}" for k in range(partitions)]


def quantiles_query(table: str, column: str, partitions: int) -> str:
    """One row with the values that cut a column into parts of equal numbers of rows."""
    cuts = ", ".join(f"percentile_disc({k}.0 / {partitions}) WITHIN GROUP "
                     f"(ORDER BY {_name(column)}) AS cut_{k}" for k in range(1, partitions))
    return f"SELECT {cuts} FROM {table}"


def range_predicates(column: str, cuts: Sequence) -> list[str]:
    """Conditions for the ranges between counted cuts, each met by a row only once.

    Cuts that repeat, as a value that fills several parts makes them, count once;
    NULL goes with the first range.
    """
    name, texts = _name(column), []
    for cut in dict.fromkeys(c for c in cuts if c is not None):
        plain = isinstance(cut, (int, float)) and not isinstance(cut, bool)
        texts.append(str(cut) if plain else "'" + _text(cut).replace("'", "''") + "'")
    if not texts:
        return []
    between = [f"{name} > {a} AND {name} <= {b}" for a, b in zip(texts, texts[1:])]
    return [f"{name} <= {texts[0]} OR {name} IS NULL", *between, f"{name} > {texts[-1]}"]


def scan_options(url: str, *, table: str | None = None, query: str | None = None,
                 fetch_size: int = 10000, connection: dict[str, str] | None = None
                 ) -> dict[str, str]:
    if (table is None) == (query is None):
        raise ValueError("name either a table or a query")
    source = table if table else f"({query}) src"
    return {"url": url, "dbtable": source, "fetchsize": str(fetch_size), **(connection or {})}


def read(spark: SparkSession, url: str, *, table: str | None = None, query: str | None = None,
         columns: Sequence[str] | None = None, split: tuple | None = None,
         fetch_size: int = 10000, connection: dict[str, str] | None = None,
         predicates: Sequence[str] = ()) -> DataFrame:
    """A table or query; ``split`` is (column, lower, upper, partitions), and
    ``predicates`` are conditions, one for each task, of which a row meets one."""
    if split and predicates:
        raise ValueError("split a read by ranges of a column or by predicates, not by both")
    options = scan_options(url, table=table, query=query, fetch_size=fetch_size,
                           connection=connection)
    if predicates:
        source = options.pop("dbtable")
        df = spark.read.jdbc(options.pop("url"), source, predicates=list(predicates),
                             properties=options)
    else:
        options.update(split_options(*split) if split else {})
        df = spark.read.format("jdbc").options(**options).load()
    return df.select(*columns) if columns else df


def bounds(spark: SparkSession, url: str, table: str, column: str,
           connection: dict[str, str] | None = None) -> tuple:
    """Least and largest value of a column, one row, to cut a whole table by."""
    name = _name(column)
    row = read(spark, url, query=f"SELECT min({name}) AS lo, max({name}) AS hi FROM {table}",
               connection=connection).first()
    return row[0], row[1]


def cuts(load_type: str, column: str | None, lower, now, partitions: int,
         whole: Callable[[], tuple]) -> tuple | None:
    """How to split a read: by the window where there is one, else by the whole table's range.

    A full load and a first run read rows of any age; cut by the window they
    would leave nearly all of them to the first task. ``whole`` asks for the range.
    """
    if column is None or partitions <= 1:
        return None
    if load_type == S.FULL or lower is None:
        lower, now = whole()
    return (column, lower, now, partitions)


def read_window(spark: SparkSession, url: str, table: str, column: str, lower: Bound,
                upper: Bound, *, partitions: int = 1, columns: Sequence[str] | None = None,
                connection: dict[str, str] | None = None) -> DataFrame:
    """Rows of a watermark window.

    The window's own bounds split the read, so tasks share just the rows asked
    for, and the window itself is a filter the database evaluates.
    """
    df = read(spark, url, table=table, split=(column, lower, upper, partitions),
              connection=connection)
    df = window_filter(df, column, lower, upper)
    return df.select(*columns) if columns else df
