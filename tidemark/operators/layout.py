"""How rows are spread over tasks and files before a write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cluster(df: DataFrame, partition_cols: Sequence[str] = (),
            distribution_cols: Sequence[str] = (), sort_cols: Sequence[str] = ()) -> DataFrame:
    """Gather rows by partition and distribution columns, sort them for lookups.

    A rebalance, not a fixed repartition: adaptive execution joins small groups
    and splits one that is larger than the advisory size, so neither a partition
    with a third of all rows nor thousands of tiny ones need special care, and
    no job has to count the groups first. Partition columns lead the sort
    because a partitioned write would otherwise sort again and undo it.
    """
    spread = [*partition_cols, *distribution_cols]
    if spread:
        df = df.hint("rebalance", *[F.col(c) for c in spread])
    order = [*partition_cols, *sort_cols]
    return df.sortWithinPartitions(*order) if sort_cols else df


def bloom_options(columns: Sequence[str], fpp: float = 0.05) -> dict[str, str]:
    if not columns:
        return {}
    return {"orc.bloom.filter.columns": ",".join(columns), "orc.bloom.filter.fpp": str(fpp)}
