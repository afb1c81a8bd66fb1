"""Merkle manifest of a dataset, with a proof for every row by octopus multiproofs.

Rows are the leaves. Those of one tree key are ordered; while several nodes
remain, every ``FAN`` consecutive ones become the hash of their digests, and
what remains is the key's subroot. Subroots, ordered by key, give the root the
same way, by the same code.

* Places: leaves (a digest, an order and what is kept, without the texts) are
  sorted over all tasks by range and written; counts of each task and key give
  a leaf its place, whatever share of the rows one key has.
* A piece is a run of up to ``PIECE`` neighbouring leaves. It hands out the
  largest nodes that it settles alone. Nodes above, which span pieces, are
  built from these in rounds; a group of a round holds what one node ``SPAN``
  levels up needs, at most ``FAN ** SPAN`` nodes, and three rounds reach 7.6 *
  10^12 leaves.
* Proofs: the paths of all leaves of a piece lack the same few nodes, a run's
  remainder at each side and level. Their coordinates are the piece's one
  request; joined with the node table they are fetched once, interior nodes
  that the paths share are derived from them and the leaves, and each leaf's
  proof is picked out inside the task.

A proof is a list of ``left`` and ``right``: the digests of the siblings before
and behind a node, joined, level by level. :func:`fold` hashes a leaf up along
it, in DataFrame expressions. Only the root comes to the driver.

Cases: null tree keys are a tree that sorts first; null orders sort first; equal
orders are settled by the leaf, and fully equal rows are leaves beside one
another; a lone leaf is its subroot, and a lone subroot the root; an empty table
gives no rows; long texts are hashed where they are read and never shuffled;
columns that aren't kept may have any name, since kept ones travel as one struct.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import staged

#: Nodes that one parent hashes.
FAN = 3
#: Leaves in a piece.
PIECE = 1 << 14
#: Rows that one task sorts.
TASK_ROWS = 1 << 20
#: Levels that one round of building goes up.
SPAN = 9

_NODES = ("piece long, tree string, n long, level int, idx long, digest string, top boolean, "
          "wanted boolean")
_STEPS = T.ArrayType(T.StructType([T.StructField("left", T.StringType()),
                                   T.StructField("right", T.StringType())]))


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 of a row: each value behind its length in bytes, ``-`` for null."""
    def part(column: Column) -> Column:
        text = column.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text),
                          F.lit("-"))
    return F.sha2(F.concat(*map(part, columns)).cast("binary"), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(
        F.concat(step["left"], node, step["right"]).cast("binary"), 256))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings of a proof, joined level by level."""
    steps = F.transform(proof, lambda step: F.concat(step["left"], step["right"]))
    return F.sha2(F.array_join(steps, "").cast("binary"), 256)


def _hash(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def _up(size: int) -> int:
    return -(-size // FAN)


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n``."""
    levels = 0
    while n > 1:
        n, levels = _up(n), levels + 1
    return levels


def largest_nodes(first: int, digests: list[str], n: int) -> Iterator[tuple[int, int, str, bool]]:
    """Nodes all of whose leaves are among ``first`` and following, but not all of the parent's.

    As (level, place, digest, whether it is the subroot).
    """
    level = 0
    while True:
        end = first + len(digests)
        if n == 1:
            yield level, 0, digests[0], True
            return
        low, high = _up(first), end // FAN if end < n else _up(n)
        if low >= high:
            low = high = _up(end)  # no parent is whole, so all stay
        for i in (*range(first, min(FAN * low, end)), *range(FAN * high, end)):
            yield level, i, digests[i - first], False
        inside = digests[FAN * low - first:FAN * high - first]
        if not inside:
            return
        digests = [_hash(inside[i:i + FAN]) for i in range(0, len(inside), FAN)]
        first, n, level = low, _up(n), level + 1


def missing(first: int, end: int, n: int) -> Iterator[tuple[int, int]]:
    """(level, place) of the nodes that the paths of leaves ``first`` to ``end`` lack."""
    level = 0
    while n > 1:
        for i in (*range(first // FAN * FAN, first), *range(end, min(_up(end) * FAN, n))):
            yield level, i
        first, end, n, level = first // FAN, _up(end), _up(n), level + 1


def _segments(table: pa.Table) -> Iterator[tuple[str, int, int, int]]:
    """(tree, number of its leaves, first row, end row) of sorted rows."""
    trees, sizes = table.column("tree").to_pylist(), table.column("n")
    start = 0
    for k in range(1, len(trees) + 1):
        if k == len(trees) or trees[k] != trees[start]:
            yield trees[start], sizes[start].as_py(), start, k
            start = k


def _sorted(table: pa.Table) -> pa.Table:
    return table.sort_by([("tree", "ascending"), ("at", "ascending")])


def _survey(table: pa.Table) -> pa.Table:
    """What a piece settles alone, and the nodes it wants."""
    table = _sorted(table)
    piece = table.column("piece")[0].as_py()
    leaves, places = table.column("leaf").to_pylist(), table.column("at").to_numpy()
    out = []
    for tree, n, start, end in _segments(table):
        first = int(places[start])
        for level, i, digest, top in largest_nodes(first, leaves[start:end], n):
            out.append((piece, tree, n, level, i, digest, top, False))
        for level, i in missing(first, first + end - start, n):
            out.append((piece, tree, n, level, i, None, False, True))
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.bool_(),
             pa.bool_())
    names = [part.split()[0] for part in _NODES.split(", ")]
    return pa.table([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds,
                                                          strict=True)], names=names)


def _build(cap: int):
    """Nodes up to level ``cap`` above the given ones of one block."""
    def build(table: pa.Table) -> pa.Table:
        """All runs are whole: what a piece did not hand out lies inside what it did."""
        n = table.column("n")[0].as_py()
        tree = table.column("tree")[0].as_py()
        levels: dict[int, dict[int, str]] = {}
        for level, i, digest in zip(*(table.column(c).to_pylist()
                                      for c in ("level", "idx", "digest")), strict=True):
            levels.setdefault(level, {})[i] = digest
        out, size = [], n
        for level in range(cap):
            here = levels.get(level, {})
            for run in sorted({i // FAN for i in here}) if size > 1 else ():
                digest = _hash([here[i] for i in range(FAN * run, min(FAN * run + FAN, size))])
                levels.setdefault(level + 1, {})[run] = digest
                out.append((level + 1, run, digest, _up(size) == 1))
            size = _up(size)
        found = list(zip(*out, strict=True)) or [()] * 4
        return pa.table({
            "tree": pa.array([tree] * len(out), pa.string()),
            "n": pa.array([n] * len(out), pa.int64()),
            "level": pa.array(found[0], pa.int32()), "idx": pa.array(found[1], pa.int64()),
            "digest": pa.array(found[2], pa.string()), "top": pa.array(found[3], pa.bool_())})
    return build


def _nodes_above(known: DataFrame, tallest: int) -> DataFrame:
    """``known`` and all nodes that span several pieces."""
    found = known.select("tree", "n", "level", "idx", "digest", "top")
    open_ = found.where(~F.col("top"))
    cap = 0
    while cap < tallest:
        cap += SPAN
        powers = F.array(*(F.lit(FAN ** k).cast("long") for k in range(cap + 1)))
        leaves_up = F.element_at(powers, F.lit(cap + 1) - F.col("level"))
        below = open_.where(F.col("level") < cap).withColumn(
            "block", ((F.col("idx") - F.col("idx") % leaves_up) / leaves_up).cast("long"))
        made = staged(below.groupBy("tree", "block").applyInArrow(
            _build(cap), "tree string, n long, level int, idx long, digest string, top boolean"),
            "merkle-nodes")
        found = found.unionByName(made)
        open_ = open_.where(F.col("level") >= cap).unionByName(
            made.where((F.col("level") == cap) & ~F.col("top")))
    return found


def _prove(schema: T.StructType):
    """Proofs of a piece's leaves, from the leaves and the fetched nodes."""
    def prove(leaves: pa.Table, fetched: pa.Table) -> pa.Table:
        leaves = _sorted(leaves)
        digests, places = leaves.column("leaf").to_pylist(), leaves.column("at").to_numpy()
        nodes, above = {}, {}
        for tree, level, i, digest, path in zip(*(
                fetched.column(c).to_pylist()
                for c in ("tree", "level", "idx", "digest", "path")), strict=True):
            if path is None:
                nodes[tree, level, i] = digest
            else:
                above[tree] = path
        left, right, picked, lengths, subroots = [], [], [], [], []
        for tree, n, start, end in _segments(leaves):
            at, low, size, level = places[start:end], int(places[start]), n, 0
            known = digests[start:end]
            columns = []
            while size > 1:
                high = low + len(known)
                run = low // FAN * FAN
                runs = [*(nodes[tree, level, i] for i in range(run, low)), *known,
                        *(nodes[tree, level, i] for i in range(high, min(_up(high) * FAN, size)))]
                columns.append(len(left) + at // FAN ** level - low)
                for i in range(low, high):
                    a = i // FAN * FAN - run
                    left.append("".join(runs[a:i - run]))
                    right.append("".join(runs[i - run + 1:a + FAN]))
                known = [_hash(runs[i:i + FAN]) for i in range(0, len(runs), FAN)]
                low, size, level = low // FAN, _up(size), level + 1
            for step in above.get(tree, ()):
                columns.append(np.full(len(at), len(left)))
                left.append(step["left"])
                right.append(step["right"])
            picked.append(np.stack(columns, 1).reshape(-1) if columns else np.zeros(0, np.int64))
            lengths.append(np.full(len(at), len(columns)))
            subroots += known * len(at)
        at = pa.array(np.concatenate(picked).astype(np.int64))
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype(np.int32)
        steps = pa.StructArray.from_arrays([pa.array(left, pa.string()).take(at),
                                            pa.array(right, pa.string()).take(at)],
                                           names=["left", "right"])
        return pa.table({
            "row": leaves.column("row"), "tree": leaves.column("tree"),
            "leaf": leaves.column("leaf"), "subroot": pa.array(subroots, pa.string()),
            "proof": pa.ListArray.from_arrays(pa.array(offsets), steps)}).select(schema.names)
    return prove


def _forest(leaves: DataFrame, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Leaves with their places, the nodes that are handed on, and the wanted ones.

    ``leaves`` has ``row``, ``tree`` (not null), ``key`` (the order) and ``leaf``.
    """
    spark = leaves.sparkSession
    rows = staged(leaves, f"{name}-leaves")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                -(-rows.count() // TASK_ROWS))
    # the last column only spreads rows that are equal in all others
    order = ["tree", "key", "leaf", "tie"]
    ordered = (rows.withColumn("tie", F.monotonically_increasing_id())
               .repartitionByRange(tasks, *order).sortWithinPartitions(*order)
               .withColumn("place", F.monotonically_increasing_id()))
    # such an id is the task's number in the upper bits, the row's in the lower 33
    ordered = staged(ordered.select(
        "row", "tree", "leaf", F.shiftright("place", 33).alias("task"),
        F.col("place").bitwiseAND(F.lit((1 << 33) - 1)).alias("nth")), f"{name}-ordered")
    in_task = ordered.groupBy("task", "tree").agg(F.count(F.lit(1)).alias("own"),
                                                  F.min("nth").alias("first"))
    by_tree = Window.partitionBy("tree")
    spans = staged(in_task.select(
        "task", "tree", "first", F.sum("own").over(by_tree).alias("n"),
        (F.sum("own").over(by_tree.orderBy("task")) - F.col("own")).alias("before")),
        f"{name}-spans")
    placed = ordered.join(spans, ["task", "tree"]).select(
        "row", "tree", "leaf", "n", (F.col("nth") - F.col("first") + F.col("before")).alias("at"),
        (F.shiftleft("task", 33).bitwiseOR(
            F.floor(F.col("nth") / PIECE))).alias("piece"))
    tallest = height(spans.agg(F.max("n")).first()[0] or 0)
    surveyed = staged(placed.drop("row").groupBy("piece").applyInArrow(_survey, _NODES),
                      f"{name}-survey")
    wanted = surveyed.where("wanted").select("piece", "tree", "level", "idx")
    nodes = _nodes_above(surveyed.where("NOT wanted"), tallest)
    return placed, nodes, wanted


def _proofs(placed: DataFrame, nodes: DataFrame, wanted: DataFrame,
            tops: DataFrame | None) -> DataFrame:
    """``row``, ``tree``, ``leaf``, ``subroot`` and ``proof``, continued by the tree's in ``tops``."""
    none = F.lit(None).cast(_STEPS)
    fetched = wanted.join(nodes.select("tree", "level", "idx", "digest"),
                          ["tree", "level", "idx"]).withColumn("path", none)
    if tops is not None:
        trees = placed.select("piece", "tree").distinct().join(tops, "tree")
        fetched = fetched.unionByName(trees.select(
            "piece", "tree", F.lit(-1).alias("level"), F.lit(-1).cast("long").alias("idx"),
            F.lit(None).cast("string").alias("digest"), F.col("path").cast(_STEPS)))
    schema = T.StructType([placed.schema["row"], placed.schema["tree"], placed.schema["leaf"],
                           T.StructField("subroot", T.StringType()),
                           T.StructField("proof", _STEPS)])
    return (placed.groupBy("piece").cogroup(fetched.groupBy("piece"))
            .applyInArrow(_prove(schema), schema))


def prove(rows: DataFrame, leaf: Column, tree: Column, order: Column,
          keep: list[Column]) -> DataFrame:
    """Per row: ``row`` (the columns ``keep``), ``leaf``, ``subroot``, ``root`` and ``proof``."""
    key = F.coalesce(F.concat(F.lit("+"), tree.cast("string")), F.lit(""))
    leaves = rows.select(F.struct(*keep).alias("row"), key.alias("tree"),
                         F.struct(order.alias("order")).alias("key"), leaf.alias("leaf"))
    placed, nodes, wanted = _forest(leaves, "merkle")
    subroots = nodes.where("top").select(
        F.struct("tree").alias("row"), F.lit("").alias("tree"),
        F.struct(F.col("tree").alias("order")).alias("key"), F.col("digest").alias("leaf"))
    upper = _forest(subroots, "merkle-top")
    of_tree = staged(_proofs(*upper, None), "merkle-top-proofs")
    top = of_tree.select("subroot").first()
    tops = of_tree.select("row.tree", F.col("proof").alias("path"))
    proved = _proofs(placed, nodes, wanted, tops)
    return proved.select("row", "leaf", "subroot",
                         F.lit(top.subroot if top else None).cast("string").alias("root"), "proof")
