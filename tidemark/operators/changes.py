"""Applying a change log (op code + order key) to a keyed target."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schema as S
from tidemark.operators.columns import align, ts_literal
from tidemark.operators.keyed import delete_matching, latest_per_key


def soft_delete_flag(op: str = S.OP_CODE) -> Column:
    return F.when(F.col(op) == S.OP_DELETE, 1).otherwise(0).cast("int")


def without_ignored(changes: DataFrame, op: str = S.OP_CODE) -> DataFrame:
    """Changes that may be inserted; an unknown (NULL) op code is not one."""
    return changes.filter(F.col(op) != S.OP_IGNORED)


def inserts_only(changes: DataFrame, op: str = S.OP_CODE) -> DataFrame:
    return changes.filter(F.col(op) == S.OP_INSERT)


def latest_changes(changes: DataFrame, keys: Sequence[str], order: str = S.TIME_KEY,
                   op: str = S.OP_CODE) -> DataFrame:
    return latest_per_key(without_ignored(changes, op), keys, order)


def reduced_changes(changes: DataFrame, keys: Sequence[str], order: str = S.TIME_KEY,
                    op: str = S.OP_CODE, load_type: str = S.INCREMENTAL, *,
                    null_safe: bool = True, delete_keys: Sequence[str] | None = None,
                    keep_newest: bool = False) -> DataFrame:
    """One change per key, for which :func:`apply_changes` gives the same result.

    The newest insertable change, or an ignored one where the key has no other,
    which still removes it. Worth staging instead of the raw log: the log is
    then read and shuffled once, and the join sees the size that counts. Loads
    that need every row (append, refusal of older changes) get the log back.
    """
    if keep_newest or (load_type == S.APPEND_ONLY and null_safe):
        return changes
    by = list(dict.fromkeys([*keys, *(delete_keys or [])]))
    marked = changes.withColumn("__insertable", F.coalesce(F.col(op) != S.OP_IGNORED, F.lit(False)))
    return latest_per_key(marked, by, ["__insertable", order]).drop("__insertable")


def as_target_rows(changes: DataFrame, load_ts: datetime | str, *, flag: str = S.DELETED_FLAG,
                   stamp: str = S.LOAD_STAMP, op: str = S.OP_CODE,
                   order: str | None = S.TIME_KEY) -> DataFrame:
    """Change rows in the target's shape: flag and stamp instead of op and order."""
    shaped = changes.withColumn(flag, soft_delete_flag(op)).withColumn(stamp, ts_literal(load_ts))
    return shaped.drop(op, *([order] if order else []))


def refuse_older(changes: DataFrame, target: DataFrame, keys: Sequence[str],
                 order: str = S.TIME_KEY) -> DataFrame:
    """Changes that are not older than the row the target already holds.

    Needs a target that stores the order column. Compared with the newest
    stored order per key, which is computed with a partial aggregate, so
    neither side is ever gathered by key without being reduced first.
    """
    names = [f"__key_{i}" for i in range(len(keys))]
    newest = (target.groupBy(*keys).agg(F.max(order).alias("__newest"))
              .toDF(*names, "__newest"))
    older = F.col(order) < F.col("__newest")
    for key, name in zip(keys, names):
        older = F.col(key).eqNullSafe(F.col(name)) & older
    return changes.join(newest, older, "left_anti")


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str], *,
                  load_ts: datetime | str, load_type: str = S.INCREMENTAL,
                  null_safe: bool = True, delete_keys: Sequence[str] | None = None,
                  order: str = S.TIME_KEY, op: str = S.OP_CODE,
                  flag: str = S.DELETED_FLAG, stamp: str = S.LOAD_STAMP,
                  keep_newest: bool = False, reduced: bool = False) -> DataFrame:
    """The target after a batch of changes.

    INCREMENTAL removes every target row whose key occurs in the batch, with
    any op code, then adds the newest insertable change per key. FULL starts
    from an empty target. APPEND_ONLY also removes matching keys, then adds all
    op-1 rows without reduction. ``null_safe=False`` is the strict-equality
    form; there APPEND_ONLY is INCREMENTAL. ``delete_keys`` names other columns
    for the delete than for the reduction.

    ``keep_newest`` keeps the order column in the target and drops changes that
    are older than it; the default lets the last batch win.

    ``reduced`` says that ``changes`` hold no key twice, as :func:`reduced_changes`
    leaves them, so that they need not be gathered by key again.
    """
    S.check_load_type(load_type)
    if load_type == S.APPEND_ONLY and not null_safe:
        load_type = S.INCREMENTAL
    if keep_newest and load_type == S.INCREMENTAL:
        changes = refuse_older(changes, target, keys, order)

    if load_type == S.APPEND_ONLY:
        chosen = inserts_only(changes, op)
    elif reduced:
        chosen = without_ignored(changes, op)
    else:
        chosen = latest_changes(changes, keys, order, op)
    added = as_target_rows(chosen, load_ts, flag=flag, stamp=stamp, op=op,
                           order=None if keep_newest else order)
    added = align(added, target.columns)
    if load_type == S.FULL:
        return added
    kept = delete_matching(target, changes, delete_keys or keys, null_safe=null_safe)
    return kept.unionByName(added)
