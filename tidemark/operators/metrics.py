"""Counts taken around a merge, and their validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Count rows as they pass, instead of running the plan twice."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias(name)), seen


def merge_metrics(target: DataFrame, incoming: DataFrame, keys: Sequence[str], *,
                  null_safe: bool = False, removing: DataFrame | None = None) -> DataFrame:
    """One row: incoming, inserted, updated and kept counts of a keyed merge.

    ``rows_updated`` counts target rows that are replaced, ``rows_inserted``
    incoming rows whose key is new. Both sides are counted per key with a
    partial aggregate over one shuffle; there is no join, and a hot key arrives
    at its reducer as one row per map task. A NULL in the key matches another
    only with ``null_safe``.

    Where other rows than the incoming ones say which keys go, they are given as
    ``removing``; ``rows_removed`` then counts target rows with their keys, and
    ``rows_kept`` the rest.
    """
    known = F.lit(True)
    for key in () if null_safe else keys:
        known = known & F.col(key).isNotNull()

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, *[F.lit(int(n == name)).alias(n) for n in ("t", "i", "r")])

    sides = side(target, "t").unionByName(side(incoming, "i"))
    if removing is not None:
        sides = sides.unionByName(side(removing, "r"))
    per_key = (sides.groupBy(*keys, known.alias("known"))
               .agg(*[F.sum(n).alias(n) for n in ("t", "i", "r")]))
    both = F.col("known") & (F.col("t") > 0) & (F.col("i") > 0)
    gone = both if removing is None else F.col("known") & (F.col("t") > 0) & (F.col("r") > 0)

    def total(column):
        return F.coalesce(F.sum(column), F.lit(0)).cast("long")

    return per_key.agg(
        total(F.col("i")).alias("rows_incoming"),
        total(F.when(~both, F.col("i"))).alias("rows_inserted"),
        total(F.when(both, F.col("t"))).alias("rows_updated"),
        *([] if removing is None else [total(F.when(gone, F.col("t"))).alias("rows_removed")]),
        total(F.when(~gone, F.col("t"))).alias("rows_kept"),
    )


def count_validate(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: both counts and whether they agree."""
    sides = (source.select(F.lit(1).alias("s"), F.lit(0).alias("t"))
             .unionByName(target.select(F.lit(0).alias("s"), F.lit(1).alias("t"))))
    return (sides.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("source_row_count"),
                      F.coalesce(F.sum("t"), F.lit(0)).alias("target_row_count"))
            .withColumn("counts_match", F.col("source_row_count") == F.col("target_row_count")))


def require_counts(source: DataFrame, target: DataFrame) -> tuple[int, int]:
    """Both counts; raises when they differ."""
    row = count_validate(source, target).first()
    if not row.counts_match:
        raise ValueError(f"count mismatch: source {row.source_row_count}, "
                         f"target {row.target_row_count}")
    return row.source_row_count, row.target_row_count
