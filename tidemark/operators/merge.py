"""Full, append and incremental merges of incoming rows into a target."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.operators.changes import apply_changes
from tidemark.operators.columns import align
from tidemark.operators.keyed import (as_bound, delete_matching, delete_matching_in_range,
                                      from_bound, key_set, latest_per_key)
from tidemark.operators.keyfilter import delete_matching_filtered


def full(target_columns: Sequence[str], incoming: DataFrame) -> DataFrame:
    return align(incoming, target_columns)


def append(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """All rows of both, with no key check."""
    return target.unionByName(align(incoming, target.columns))


def merge_flat(target: DataFrame, incoming: DataFrame, keys: Sequence[str], *,
               null_safe: bool = False, dedupe: str | Sequence[str] | None = None,
               range_key: str | None = None, key_filter: bool = False) -> DataFrame:
    """Target rows whose key is not incoming, plus every incoming row.

    Incoming rows that share a key are all kept unless ``dedupe`` names the
    columns that decide the newest. ``range_key`` names a key column that grows
    with time; target rows outside the incoming range of it are not joined. For
    keys that don't, ``key_filter`` has the target tested against bits of the
    incoming keys before it is shuffled.
    """
    incoming = align(incoming, target.columns)
    if dedupe:
        incoming = latest_per_key(incoming, keys, dedupe)
    if range_key:
        kept = delete_matching_in_range(target, incoming, keys, range_key, null_safe=null_safe)
    elif key_filter:
        kept = delete_matching_filtered(target, incoming, keys, null_safe=null_safe)
    else:
        kept = delete_matching(target, incoming, keys, null_safe=null_safe)
    return kept.unionByName(incoming)


def affected_partitions(incoming: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    return incoming.select(*partition_cols).distinct()


def prune_to(target: DataFrame, partitions: DataFrame,
             partition_cols: Sequence[str]) -> DataFrame:
    """Target rows in the listed partitions.

    ``partitions`` holds distinct partition values. Their range per column is a
    filter that keeps the scan from listing directories outside it; a semi-join
    makes it exact. One row, the ranges, comes to the driver.
    """
    names = [f"__part_{i}" for i in range(len(partition_cols))]
    same = reduce(lambda a, b: a & b,
                  [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(partition_cols, names)])
    return _within_ranges(target, partitions, partition_cols).join(
        partitions.select(*partition_cols).toDF(*names), same, "left_semi")


def _within_ranges(target: DataFrame, partitions: DataFrame,
                   columns: Sequence[str]) -> DataFrame:
    types = {c: partitions.schema[c].dataType for c in columns}
    row = partitions.agg(*[F.struct(as_bound(F.min(c), types[c]).alias("lo"),
                                    as_bound(F.max(c), types[c]).alias("hi"),
                                    F.count_if(F.col(c).isNull()).alias("nulls")).alias(c)
                           for c in columns]).first()
    for column in columns:
        found = row[column]
        test = F.col(column).between(from_bound(found.lo, types[column]),
                                     from_bound(found.hi, types[column]))
        target = target.filter(test | F.col(column).isNull() if found.nulls else test)
    return target


def merge_partitioned(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                      partition_cols: Sequence[str], *, null_safe: bool = False,
                      dedupe: str | Sequence[str] | None = None) -> DataFrame:
    """New contents of the partitions that incoming rows fall into.

    To be published with a dynamic partition overwrite; other partitions are
    not read. A key whose row moved to another partition keeps its old copy
    there, as the merge never looks at that partition; where keys can move use
    :func:`merge_partitioned_global`.
    """
    touched = prune_to(target, affected_partitions(incoming, partition_cols),
                       partition_cols)
    return merge_flat(touched, incoming, keys, null_safe=null_safe, dedupe=dedupe)


def partitions_holding(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                       partition_cols: Sequence[str], *, null_safe: bool = False) -> DataFrame:
    """Target partitions that hold a key that comes in. Reads keys and partition columns."""
    names = [f"__key_{i}" for i in range(len(keys))]
    marked = key_set(incoming, keys, null_safe).toDF(*names)
    same = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    return (target.select(*dict.fromkeys([*keys, *partition_cols]))
            .join(marked, same, "left_semi").select(*partition_cols).distinct())


def touched_partitions(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                       partition_cols: Sequence[str], *, null_safe: bool = False) -> DataFrame:
    """Partitions incoming rows fall into, and those their keys are stored in now."""
    old = partitions_holding(target, incoming, keys, partition_cols, null_safe=null_safe)
    return old.unionByName(affected_partitions(incoming, partition_cols)).distinct()


def merge_partitioned_global(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                             partition_cols: Sequence[str], *, null_safe: bool = False,
                             dedupe: str | Sequence[str] | None = None) -> DataFrame:
    """Like :func:`merge_partitioned`, but also covers partitions a key moved away from.

    A partition may end up empty; publish with ``replace_partitions``.
    """
    touched = touched_partitions(target, incoming, keys, partition_cols, null_safe=null_safe)
    return merge_flat(prune_to(target, touched, partition_cols),
                      incoming, keys, null_safe=null_safe, dedupe=dedupe)


class PartitionResult(NamedTuple):
    """New contents of the touched partitions, one of which may have become empty."""

    rows: DataFrame
    touched: DataFrame
    may_empty: bool


def apply_in_partitions(target: DataFrame, changes: DataFrame, keys: Sequence[str],
                        partition_cols: Sequence[str], *, load_type: str = S.INCREMENTAL,
                        op: str = S.OP_CODE, moved: bool = True,
                        **options) -> PartitionResult:
    """Apply changes to the partitions they concern and read no others.

    These are the partitions changes fall into and, as a key's row may have
    been in another one, those that hold a changed key now. Where the partition
    columns follow from the key, ``moved=False`` saves that look. ``changes`` is
    read more than once: stage it.
    """
    if moved:
        null_safe = options.get("null_safe", True)
        touched = touched_partitions(target, changes, keys, partition_cols, null_safe=null_safe)
    else:
        touched = affected_partitions(changes, partition_cols)
    scope = prune_to(target, touched, partition_cols)
    rows = apply_changes(scope, changes, keys, load_type=load_type, op=op, **options)
    # ignored and unknown ops remove a key; every other op leaves a row, flagged or not
    removing = changes.filter(F.coalesce(F.col(op), F.lit(S.OP_IGNORED)) == S.OP_IGNORED)
    may_empty = moved or load_type != S.INCREMENTAL or not removing.isEmpty()
    return PartitionResult(rows, touched, may_empty)


def upsert_rows(target: DataFrame, rows: DataFrame, keys: Sequence[str],
                load_type: str) -> DataFrame:
    """File load: FULL replaces, otherwise strict keyed delete and all rows added."""
    rows = align(rows, target.columns)
    if load_type == S.FULL:
        return rows
    return delete_matching(target, rows, keys).unionByName(rows)


def cross_sync(target: DataFrame, window: DataFrame, keys: Sequence[str],
               load_type: str) -> DataFrame:
    """Database-to-database sync: null-safe keyed delete, insert by the target's names."""
    rows = align(window, target.columns)
    if load_type == S.FULL:
        return rows
    return delete_matching(target, rows, keys, null_safe=True).unionByName(rows)
