"""Exact top-k search by MaxScore over sharded postings.

Vectors are read as term weights: dimension d gives the terms (d, +) and
(d, -). A query's term adds to a score only in postings of its own sign, and
there by at most its weight times the largest weight of the list. In a shard,
the terms of least bound whose bounds together stay below the tenth best score
so far are non-essential: a vector in none of the other lists can't get in.
The essential lists are traversed, vectors that could still compete are probed
in the others, largest bound first, and each shard hands on its best; shards
are merged by rank.

Queries travel in blocks of ``QUERY_BLOCK`` and meet every shard, so nothing
is broadcast and no pair of rows is made before it competes. What a shard
passes on is k rows for each query.

Cases: vectors that are null or hold null or non-finite components take no
part, neither do null ids; missing components of a shorter vector count as 0,
an empty vector scores 0 with all; repeated equal rows count once; a row is
not a candidate of a query with its own id; ties go to the smaller id; with
fewer than k candidates all are returned; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Candidates in a shard, and queries in a block.
SHARD_ROWS = 16_384
QUERY_BLOCK = 2_048
#: Candidates whose postings are traversed at once.
_STRIDE = 4_096

_HITS = "query_id long, vec_id long, score long"


def _weights(vectors: Column) -> Column:
    """floor(1024 x) of each component."""
    return F.transform(vectors, lambda x: F.floor(x.cast("double") * 1024).cast("long"))


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for at, row in enumerate(rows):
        out[at, :len(row)] = row
    return out


class _Postings:
    """The lists of one stretch of candidates, with the largest weight of each."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray) -> None:
        self.ids, self.weights = ids, np.ascontiguousarray(weights.T)  # a row for each term
        self.most = weights.max(axis=0, initial=0)
        self.least = weights.min(axis=0, initial=0)

    def best(self, own_id: int, query: np.ndarray, k: int, found: tuple) -> tuple:
        """``found`` (scores, ids; best first) improved by these candidates."""
        bound = np.maximum(query * self.most, query * self.least)
        terms = np.argsort(bound, kind="stable")
        full = len(found[0]) >= k
        floor = found[0][-1] if full else None
        upto = np.cumsum(bound[terms])
        # non-essential: the bounds of the first so many terms stay below the floor
        spare = int(np.searchsorted(upto, floor, side="left")) if full else 0
        essential = terms[spare:]
        if not len(essential) and full:
            return found
        at = np.flatnonzero(self.ids != own_id)
        if full and spare:
            signs = np.sign(query[essential])[:, None] * self.weights[essential]
            at = at[(signs > 0).any(axis=0)[at]]
        scores = query[essential] @ self.weights[essential][:, at]
        for place in range(spare - 1, -1, -1):
            if full:
                alive = scores + upto[place] >= floor
                at, scores = at[alive], scores[alive]
            if not len(at):
                return found
            term = terms[place]
            scores = scores + query[term] * self.weights[term, at]
        if full:
            alive = scores >= floor
            at, scores = at[alive], scores[alive]
        scores = np.concatenate([found[0], scores])
        ids = np.concatenate([found[1], self.ids[at]])
        order = np.lexsort((ids, -scores))[:k]
        return scores[order], ids[order]


def _search(k: int):
    def search(queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        hits: list[tuple] = []
        if len(queries) and len(shard):
            width = int(max(queries["w"].map(len).max(), shard["w"].map(len).max()))
            ids = shard["vec_id"].to_numpy(np.int64)
            stretches = [_Postings(ids[a:a + _STRIDE], _matrix(shard["w"][a:a + _STRIDE], width))
                         for a in range(0, len(ids), _STRIDE)]
            for own_id, query in zip(queries["vec_id"], _matrix(queries["w"], width),
                                     strict=True):
                found = (np.zeros(0, np.int64), np.zeros(0, np.int64))
                for postings in stretches:
                    found = postings.best(own_id, query, k, found)
                hits += [(own_id, i, s) for s, i in zip(*found, strict=True)]
        return pd.DataFrame(hits, columns=["query_id", "vec_id", "score"]).astype("int64")
    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id",
          vector_col: str = "embedding", shard_rows: int = SHARD_ROWS,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k best of each query.

    ``is_query`` is a condition on ``vec_id``.
    """
    given = F.col(vector_col)
    whole = given.isNotNull() & F.forall(given, lambda x: x.isNotNull() & ~F.isnan(x)
                                         & (F.abs(x) < F.lit(float("inf"))))
    rows = (vectors.where(F.col(id_col).isNotNull() & whole)
            .select(F.col(id_col).cast("long").alias("vec_id"), _weights(given).alias("w"))
            .distinct())
    n, n_queries = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-n // shard_rows), min(4 * tasks, n // 512))
    blocks = max(1, -(-n_queries // query_block))
    place = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).alias("shard")
    block = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).alias("block")
    candidates = rows.select("vec_id", "w", place,
                             F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    queries = rows.where(is_query).select(
        "vec_id", "w", block, F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    keys = [F.col("shard").cast("long"), F.col("block").cast("long")]
    hits = (queries.groupBy(*keys).cogroup(candidates.groupBy(*keys))
            .applyInPandas(_search(k), _HITS))
    # equal ids with other vectors may bring a candidate twice: each row counts
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
