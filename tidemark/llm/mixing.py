"""Mixing overlapping sources to target weights by min-cost flow.

Documents are first summed by membership pattern, the set of sources a
document belongs to. A flow network routes words from patterns to sources:
each pattern offers its words once for nothing, a second time at cost 1, a
third at cost 2 and so on (convex repetition), and each source takes its
quota. The cheapest largest flow says how many words each pattern gives. Then
documents are chosen: every document of a pattern goes in as often as whole
passes of the pattern are needed, and the rest of the words comes from the
documents that a seeded hash puts first, as long as their sum stays within the
rest. What is then still owed, less than the document at that cut has, is filled
from the documents behind it: the longest that still fit, sizes in falling
order, by hash among equal ones, and at last the next longer one if the sum comes
nearer with it. So no document that was left out would bring a pattern nearer.

The driver sees one row for each pattern, and the sizes that fill it. The cut
between chosen and other documents is found by a histogram over the first digits
of the hash and exact running sums in the one bucket that holds the cut, so no
group is sorted whole. Behind the cut documents are counted by size, up to twice
what is owed, which is less than twice the longest document.

Cases: a null text has size 0; a null or empty source is a source like any
other, null last; documents of size 0 are never taken; rows that share an id
share a hash, so all or none of them are taken; null ids are hashed as
empty text; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Most often a document may be taken.
MOST_COPIES = 3

#: Rows of the plan, one for each pattern, that may be broadcast.
BROADCAST_PATTERNS = 50_000


def water_fill(sizes: list[int], weights: list[int], most: int = MOST_COPIES) -> list[float]:
    """Targets that share the total by weight, none above ``most`` times its size.

    Sources reach their cap in the order of size over weight; after the first
    k of them the level is what is left for each unit of weight that is left.
    """
    order = sorted(range(len(sizes)), key=lambda i: (most * sizes[i] / weights[i], i))
    left, weight, level = sum(sizes), sum(weights), 0.0
    for i in order:
        level = left / weight
        if most * sizes[i] / weights[i] >= level:
            break
        left -= most * sizes[i]
        weight -= weights[i]
    return [min(float(most * s), level * w) for s, w in zip(sizes, weights, strict=True)]


@dataclass
class _Arc:
    to: int
    room: int
    cost: int


def route(capacity: list[int], members: list[list[int]], quotas: list[int],
          most: int = MOST_COPIES) -> list[dict[int, int]]:
    """Words that each pattern gives to each of its sources, at the least repetition.

    ``members[p]`` lists the sources of pattern p. Shortest augmenting paths
    on patterns and sources; documents never appear here.
    """
    n_p, n_s = len(capacity), len(quotas)
    start, end = n_p + n_s, n_p + n_s + 1
    arcs: list[_Arc] = []
    out: list[list[int]] = [[] for _ in range(end + 1)]

    def join(a: int, b: int, room: int, cost: int) -> int:
        out[a].append(len(arcs))
        arcs.append(_Arc(b, room, cost))
        out[b].append(len(arcs))
        arcs.append(_Arc(a, 0, -cost))
        return len(arcs) - 2

    given: list[dict[int, int]] = []
    for p, sources in enumerate(members):
        for copy in range(most):
            join(start, p, capacity[p], copy)
        given.append({s: join(p, n_p + s, most * capacity[p], 0) for s in sources})
    for s, quota in enumerate(quotas):
        join(n_p + s, end, quota, 0)
    while True:
        far = [None] * (end + 1)
        via = [-1] * (end + 1)
        far[start] = 0
        waiting = deque([start])
        queued = {start}
        while waiting:
            at = waiting.popleft()
            queued.discard(at)
            for k in out[at]:
                arc = arcs[k]
                if arc.room > 0 and (far[arc.to] is None or far[at] + arc.cost < far[arc.to]):
                    far[arc.to], via[arc.to] = far[at] + arc.cost, k
                    if arc.to not in queued:
                        waiting.append(arc.to)
                        queued.add(arc.to)
        if far[end] is None:
            break
        path, at = [], end
        while at != start:
            path.append(via[at])
            at = arcs[via[at] ^ 1].to
        step = min(arcs[k].room for k in path)
        for k in path:
            arcs[k].room -= step
            arcs[k ^ 1].room += step
    return [{s: arcs[k ^ 1].room for s, k in arc.items()} for arc in given]


def placed(members: F.Column, id_col: str = "doc_id",
           text_col: str = "text", seed: str = "mix") -> list[F.Column]:
    """Columns ``members``, ``size`` in words and ``seeded``, the hash that orders documents."""
    return [members.alias("members"),
            F.coalesce(F.regexp_count(F.col(text_col).cast("string"),
                                      F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
            .cast("long").alias("size"),
            F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
            .alias("seeded")]


def _small(spark, rows: list, sized: DataFrame, columns: str) -> DataFrame:
    """One row for each pattern; broadcast up to a fixed number of them."""
    kind = sized.schema["members"].dataType.simpleString()
    df = spark.createDataFrame(rows, f"members {kind}, {columns}")
    return F.broadcast(df) if len(rows) <= BROADCAST_PATTERNS else df


def fill(owed: int, sizes: dict[int, int]) -> dict[int, int]:
    """How many documents of each size to take for the words still owed.

    ``sizes`` says how many there are. The longest that fit come first; one that
    overshoots is added if that is nearer.
    """
    taken = dict.fromkeys(sizes, 0)
    for size in sorted(sizes, reverse=True):
        taken[size] = min(sizes[size], owed // size)
        owed -= taken[size] * size
    longer = min((s for s, n in sizes.items() if s > owed and taken[s] < n), default=None)
    if longer is not None and longer - owed < owed:
        taken[longer] += 1
    return {size: n for size, n in taken.items() if n}


class Mix(NamedTuple):
    """How a mix is made up."""

    plan: DataFrame   # members, passes, cut, fills (size -> last hash): one row for each pattern
    routes: list      # (members, source, words)
    sources: dict     # source -> (size, words wanted)
    most: int


def plan_mix(sized: DataFrame, targets, most: int = MOST_COPIES) -> Mix:
    """The mix of documents given as ``members``, ``size`` and ``seeded``.

    ``targets`` is called with the list of sources (code point order, null
    last) and their sizes in words and returns the words wanted of each.
    """
    spark = sized.sparkSession
    patterns = sized.groupBy("members").agg(F.sum("size").alias("size")).collect()
    patterns.sort(key=lambda r: [(x is None, x or "") for x in r.members])
    names = sorted({x for r in patterns for x in r.members}, key=lambda x: (x is None, x or ""))
    place = {x: i for i, x in enumerate(names)}
    capacity = [int(r.size) for r in patterns]
    members = [[place[x] for x in r.members] for r in patterns]
    sizes = [sum(c for c, m in zip(capacity, members, strict=True) if i in m)
             for i in range(len(names))]
    wanted = targets(names, sizes)
    routed = route(capacity, members, [int(t + 0.5) for t in wanted], most)
    plan = []
    for r, size, flow in zip(patterns, capacity, routed, strict=True):
        words = sum(flow.values())
        passes = words // size if size else 0
        plan.append((list(r.members), int(passes), int(words - passes * size)))
    rests = _small(spark, plan, sized, "passes long, rest long")

    # the leading digits of the hash at which the running size passes the rest
    bucket = F.substring("seeded", 1, 3)
    so_far = F.sum("words").over(Window.partitionBy("members").orderBy("bucket"))
    buckets = (sized.groupBy("members", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
               .join(rests, "members").withColumn("before", so_far - F.col("words"))
               .where((F.col("before") <= F.col("rest"))
                      & (F.col("before") + F.col("words") > F.col("rest"))))
    cuts = [(list(r.members), r.bucket, int(r.before), int(r.rest)) for r in buckets.collect()]
    cut_at = _small(spark, cuts, sized, "bucket string, before long, rest long")
    # in that bucket, the last document with which the sum stays within the rest
    so_far = F.col("before") + F.sum("words").over(
        Window.partitionBy("members").orderBy("seeded"))
    last = (sized.withColumn("bucket", bucket).join(cut_at, ["members", "bucket"])
            .groupBy("members", "before", "rest", "seeded").agg(F.sum("size").alias("words"))
            .withColumn("after", so_far).where(F.col("after") <= F.col("rest"))
            .groupBy("members").agg(F.max("seeded").alias("cut"), F.max("after").alias("after"))
            .collect())
    at = {tuple(m): (b, rest - before) for m, b, before, rest in cuts}
    rest_of = {tuple(m): rest for m, _, _, rest in cuts}
    at |= {tuple(r.members): (r.cut, rest_of[tuple(r.members)] - int(r.after)) for r in last}
    fills = _fills(sized, [(list(m), cut, owed) for m, (cut, owed) in at.items() if owed > 0])
    rows = [(m, passes, at.get(tuple(m), ("", 0))[0], fills.get(tuple(m), {}))
            for m, passes, _ in plan]
    routes = [(list(r.members), names[s], words)
              for r, flow in zip(patterns, routed, strict=True) for s, words in flow.items()]
    columns = "passes long, cut string, fills map<long,string>"
    return Mix(_small(spark, rows, sized, columns), routes,
               {s: (z, w) for s, z, w in zip(names, sizes, wanted, strict=True)}, most)


def _fills(sized: DataFrame, owing: list) -> dict[tuple, dict[int, str]]:
    """For each pattern that owes words behind its cut: size -> last hash that is taken."""
    if not owing:
        return {}
    spark = sized.sparkSession
    behind = sized.join(_small(spark, owing, sized, "cut string, owed long"), "members").where(
        (F.col("seeded") > F.col("cut")) & F.col("size").between(1, 2 * F.col("owed") - 1))
    counted: dict[tuple, tuple[int, dict[int, int]]] = {}
    for r in behind.groupBy("members", "owed", "size").count().collect():
        counted.setdefault(tuple(r.members), (r.owed, {}))[1][r.size] = r["count"]
    picks = [(list(m), size, n) for m, (owed, sizes) in counted.items()
             for size, n in fill(owed, sizes).items()]
    if not picks:
        return {}
    wanted = _small(spark, picks, sized, "size long, wanted long")
    wanted = wanted.withColumnsRenamed({"members": "of", "size": "of_size"})
    of_size = (F.col("size") == F.col("of_size")) & (F.col("members") == F.col("of"))
    found = behind.join(wanted, of_size).groupBy("members", "size", "wanted", "seeded").agg(
        F.count(F.lit(1)).alias("own")).withColumn("bucket", F.substring("seeded", 1, 3))

    def so_far(*keys: str) -> F.Column:
        return F.sum("own").over(Window.partitionBy(*keys).orderBy("seeded"))

    # each bucket of hashes is cut first, so no size is sorted whole
    for keys in (["members", "size", "bucket"], ["members", "size"]):
        found = found.withColumn("nth", so_far(*keys)).where(F.col("nth") <= F.col("wanted"))
    fills: dict[tuple, dict[int, str]] = {}
    for r in found.groupBy("members", "size").agg(F.max("seeded").alias("last")).collect():
        fills.setdefault(tuple(r.members), {})[r.size] = r["last"]
    return fills


def with_copies(docs: DataFrame, mix: Mix) -> DataFrame:
    """``docs``, which have ``members``, ``size`` and ``seeded``, with ``copies`` of each."""
    filling = F.coalesce(F.col("seeded") <= F.try_element_at("fills", F.col("size")), F.lit(False))
    extra = ((F.col("seeded") <= F.col("cut")) | filling).cast("long")
    return (docs.join(mix.plan, "members").withColumn(
        "copies", F.when(F.col("size") > 0, F.least(F.col("passes") + extra,
                                                    F.lit(mix.most).cast("long")))
        .otherwise(F.lit(0).cast("long"))).drop("passes", "cut", "fills"))


def source_table(spark, mix: Mix) -> DataFrame:
    """``source``, ``source_size`` and ``target`` of the mix."""
    rows = [(source, int(size), float(target)) for source, (size, target) in mix.sources.items()]
    df = spark.createDataFrame(rows, "source string, source_size long, target double")
    return F.broadcast(df) if len(rows) <= BROADCAST_PATTERNS else df


def repeating_weights(sources: list, sizes: list[int], weights=(5, 2, 1),
                      most: int = MOST_COPIES) -> list[float]:
    """Targets for sources that weigh 5, 2, 1, 5, 2, 1 … in order."""
    own = [weights[i % len(weights)] for i in range(len(sources))]
    return water_fill(sizes, own, most) if sources else []
