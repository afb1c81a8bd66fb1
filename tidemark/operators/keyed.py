"""Keyed delete and latest-row selection: the two wide steps of every merge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_set(df: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """Distinct keys of ``df``; without ``null_safe`` keys holding a NULL go away."""
    found = df.select(*[F.col(k) for k in keys])
    if not null_safe:
        found = found.dropna()
    return found.distinct()


def delete_matching(target: DataFrame, incoming: DataFrame, keys: Sequence[str], *,
                    incoming_keys: Sequence[str] | None = None,
                    null_safe: bool = False) -> DataFrame:
    """Rows of ``target`` whose key does not occur in ``incoming``.

    ``null_safe`` decides whether a NULL key equals another NULL key. In both
    forms the join itself is null-safe; the strict form has no NULL left on the
    incoming side to match.

    The incoming side is reduced to distinct keys on the map side first, so a
    key that fills a third of the change log is one row. Because the join keys
    differ in form from the grouping keys, both join inputs sit directly on
    their own exchange, which is what lets adaptive execution split a hot key
    of the target over several tasks, or switch to a broadcast once it has
    measured the keys to be small.
    """
    incoming_keys = list(incoming_keys or keys)
    names = [f"__key_{i}" for i in range(len(incoming_keys))]
    right = key_set(incoming, incoming_keys, null_safe).toDF(*names)
    same = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    return target.join(right, same, "left_anti")


def as_bound(value: Column, dtype: T.DataType) -> Column:
    """A range's end in a form that survives the way over the driver.

    A Python datetime would pick up the machine's time zone, and a local time
    as text means two moments when clocks are set back: moments travel as
    microseconds, bytes as hexadecimal digits, the rest as text.
    """
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(dtype, T.BinaryType):
        return F.hex(value)
    return value.cast("string")


def from_bound(text: str | None, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampType) and text is not None:
        return F.timestamp_micros(F.lit(int(text)))
    if isinstance(dtype, T.BinaryType):
        return F.unhex(F.lit(text))
    return F.lit(text).cast(dtype)


def delete_matching_in_range(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                             range_key: str, *, null_safe: bool = False) -> DataFrame:
    """:func:`delete_matching` that joins only target rows within the incoming key range.

    For keys that grow with time, where a batch meets a narrow range of a large
    target: rows below or above it cannot match and skip the join's shuffle.
    Both halves are filters a columnar scan can skip stripes by. One row, the
    range, comes to the driver.
    """
    key = F.col(range_key)
    dtype = incoming.schema[range_key].dataType
    found = incoming.agg(as_bound(F.min(key), dtype).alias("lo"),
                         as_bound(F.max(key), dtype).alias("hi"),
                         F.count_if(key.isNull()).alias("nulls")).first()
    nulls_match = null_safe and found.nulls > 0
    if found.lo is None:
        return delete_matching(target, incoming, keys, null_safe=null_safe) if nulls_match else target
    lo, hi = from_bound(found.lo, dtype), from_bound(found.hi, dtype)
    inside, outside = (key >= lo) & (key <= hi), (key < lo) | (key > hi)
    if nulls_match:
        inside = inside | key.isNull()
    else:
        outside = outside | key.isNull()
    joined = delete_matching(target.filter(inside), incoming, keys, null_safe=null_safe)
    return joined.unionByName(target.filter(outside))


def _descending(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_first() for c in columns]


def orderable(df: DataFrame, skip: Sequence[str]) -> list[str]:
    """Columns that can break a tie, in schema order."""
    return [f.name for f in df.schema.fields
            if f.name not in skip and not isinstance(f.dataType, (T.MapType, T.VariantType))]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str | Sequence[str],
                   ties: Sequence[str] | None = None) -> DataFrame:
    """The newest row of each key; NULL sorts as newest, as the source databases do.

    Rows equal in ``order`` are settled by the remaining columns, so a rerun
    returns the same row. Spark turns ``row_number() = 1`` into a per-partition
    limit before the shuffle: each map task sends at most one row per key, so a
    hot key costs no more than any other.
    """
    order = [order] if isinstance(order, str) else list(order)
    if ties is None:
        ties = orderable(df, [*keys, *order])
    window = Window.partitionBy(*keys).orderBy(*_descending(order), *_descending(ties))
    return (df.withColumn("__rank", F.row_number().over(window))
            .filter(F.col("__rank") == 1)
            .drop("__rank"))
