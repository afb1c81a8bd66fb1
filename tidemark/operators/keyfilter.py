"""Bits of hashed keys: a fixed-size table that tells most rows which keys they don't have.

A key's hash names one of ``2 ** bits`` slots; 64 slots are a word, and a row of
the table is a word with its set bits. So the table has at most ``2 ** bits /
64`` rows whatever it is made of (4 MB of numbers at 24 bits), which is what
lets it be broadcast. A set bit may be another key's; a bit that isn't set is
proof. Everything is built-in expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.keyed import delete_matching, key_set

#: Slots of a filter, as a power of two.
BITS = 24

# equal values of these types have equal hashes; floats have several zeros
_HASHABLE = (T.IntegralType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType,
             T.DecimalType, T.BooleanType, T.BinaryType)


def comparable(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> bool:
    """Whether equal keys of both have equal hashes."""
    return all(a.schema[k].dataType == b.schema[k].dataType
               and isinstance(a.schema[k].dataType, _HASHABLE) for k in keys)


def _slot(keys: Sequence[str], bits: int) -> Column:
    return F.xxhash64(*keys).bitwiseAND(F.lit((1 << bits) - 1))


def word_of(keys: Sequence[str], bits: int = BITS) -> Column:
    return F.shiftright(_slot(keys, bits), 6)


def bit_of(keys: Sequence[str], bits: int = BITS) -> Column:
    place = _slot(keys, bits).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def key_bits(df: DataFrame, keys: Sequence[str], bits: int = BITS,
             by: Sequence[str] = ()) -> DataFrame:
    """The table, ``word`` and ``bits``; one for each value of the columns ``by``."""
    marked = df.select(*by, word_of(keys, bits).alias("word"), bit_of(keys, bits).alias("bit"))
    return marked.groupBy(*by, "word").agg(F.bit_or("bit").alias("bits"))


def delete_matching_filtered(target: DataFrame, incoming: DataFrame, keys: Sequence[str], *,
                             null_safe: bool = False, bits: int = BITS) -> DataFrame:
    """:func:`delete_matching` that shuffles only target rows whose key may be incoming.

    For keys that don't grow with time, where a batch has few of a large
    target's keys anywhere in their range. The rest of the target is read a second
    time and passes. Keys whose hashes can't be compared are deleted without a
    filter.
    """
    if not comparable(target, incoming, keys):
        return delete_matching(target, incoming, keys, null_safe=null_safe)
    wanted = key_bits(key_set(incoming, keys, null_safe), keys, bits)
    wanted = F.broadcast(wanted.toDF("__word", "__bits"))
    looked = target.join(wanted, word_of(keys, bits) == F.col("__word"), "left")
    may = F.coalesce(F.col("__bits"), F.lit(0)).bitwiseAND(bit_of(keys, bits)) != 0
    joined = delete_matching(looked.filter(may).select(*target.columns), incoming, keys,
                             null_safe=null_safe)
    return joined.unionByName(looked.filter(~may).select(*target.columns))
