"""N-gram Jaccard join, heavy and light by set size.

A document is the set of its word shingles; equal sets are one class and join
as one. Two sets of a and b shingles link when they share at least
o(a, b) = ceil(t (a + b) / (100 + t)) of them, t the threshold in percent.

* Light sets are small enough to list every subset of o(a, b) shingles for
  each size b of a possible partner. Linked light sets have such a subset in
  common.
* Heavy sets are found by inverted lists. All shingles have one global order,
  the rarest first; a linked pair shares one of the first n - ceil(t n / 100) + 1
  shingles of either set, so only these are posted. A light set whose partner
  may be heavy is posted as well. Rarity is estimated by counts in a table of
  fixed size, where shingles that fall into one cell count together: any order
  gives the same links, and frequent shingles come last whatever the corpus
  holds. A shingle alone in its cell is in one set only and isn't posted. The
  other keys are counted first by prints of 32 bits, which travel sorted in a byte
  or two each: what no second class has isn't posted either. A print that two keys
  share only posts more.
* The boundary between the two is the set size at which subsets and postings
  cost least for the sizes that the documents have.

Postings travel packed, a key and a set each, and a task sends of the sets
under one key only one to the key's bucket, so a key that a third of all sets
have reaches it once for each half a million postings.

Lists are not turned into all their pairs. The head of a list is its most
central member, the one with most shingles that come up more often than usual,
less those that don't: of the versions of a text the one that the others were
made from, where it is there. First every set is compared with one set, the
head that most of its lists have. That joins copies and versions of a text,
however many, along a star. What is left are lists that still hold several
components. Only pairs from different components are made from them, where the
places of the shingle in both sets leave room for what they must share, and of
these only pairs that meet in as many lists as they must are compared in full:
linked sets share j of the first n - o(a, b) + j shingles of either. So no link
between components is lost and none within one is made twice. Versions that are
near one another but near no head make many pairs.
What is returned are classes and components only: links inside a component that
the star has joined are neither made nor counted.

Cases: null and empty texts have the empty set, which links with nothing; a
text of fewer words than a shingle is one shingle; rows without an id take no
part; rows that share an id are one document, whose sets link with each
other; ids must be integral; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import slices, staged, text_bytes
from tidemark.llm.components import components
from tidemark.llm.hashing import mixed

#: Words in a shingle, and the least Jaccard similarity in percent.
SHINGLE = 5
THRESHOLD = 80
#: Cells in which shingles are counted for the global order, a byte each when broadcast.
CELLS = 1 << 24
#: Cells that are summed together.
CELL_BLOCK = 1 << 13
#: What one posting costs, counted in listed subsets, as its list is scanned.
POSTING_COST = 4
#: Largest set for which subsets are considered.
MOST_LIGHT = 24
#: Part of the shingles that a linked set may lack by which prefixes of a pair are
#: lengthened, so that the lists it meets in can be counted.
MET_PART = 16
#: Postings that a task holds before it packs them, and packed bytes of one bucket.
PACKED_ROWS = 1 << 19
BUCKET_BYTES = 8 << 20
#: Prints that a task holds before it packs them, the least number of their buckets, and
#: bits that tell which prints come up again (16 MB, broadcast).
PACKED_PRINTS = 1 << 21
PRINT_BUCKETS = 1 << 8
AGAIN_BITS = 1 << 27

#: Half powers of two; a cell below ``_ALONE`` holds one shingle of one set, or none.
_LEVELS = np.unique(np.ceil(2 ** (np.arange(64) / 2)).astype(np.int64))
_ALONE = 2
_LEVEL_AT = np.int64(56)
#: Bits of a shingle's hash that the name of its list does without; lists that share a
#: name only make more pairs to compare.
_UNNAMED_BITS = np.int64(16)
_SALT = np.uint64(0xA0761D6478BD642F)
_PRINT_SALT = np.uint64(0xE7037ED1A0B428DB)
_PRINTS = 1 << 32
_K = np.uint64(0x9E3779B97F4A7C15)


def needed(a, b, threshold: int = THRESHOLD):
    """Shingles that linked sets of a and b shingles share at least."""
    return (threshold * (a + b) + 99 + threshold) // (100 + threshold)


def _posted(n: int, threshold: int) -> int:
    return n - (threshold * n + 99) // 100 + 1


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """The set as sorted hashes of 62 bits."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.int64)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    size = min(size, len(words))
    n = len(words) - size + 1
    found = np.full(n, size, np.uint64)
    for k in range(size):
        found = (found ^ hashes[k:k + n]) * _K
        found ^= found >> np.uint64(32)
    found *= np.uint64(0xD6E8FEB86659FD93)
    return np.unique((found >> np.uint64(2)).astype(np.int64))


def _subset_sizes(n: int, light: int, threshold: int) -> list[int]:
    """Sizes of the subsets by which a light set meets its light partners."""
    least, most = (threshold * n + 99) // 100, min(light, 100 * n // threshold)
    return sorted({int(needed(n, m, threshold)) for m in range(max(1, least), most + 1)})


def _is_posted(n: int, light: int, threshold: int) -> bool:
    return n > light or 100 * n // threshold > light


def _listed(sizes: dict[int, int], light: int, threshold: int) -> int:
    """Postings and subsets of so many sets of each size."""
    return sum(count * ((_posted(n, threshold) if _is_posted(n, light, threshold) else 0)
                        + sum(comb(n, c) for c in _subset_sizes(n, light, threshold)
                              if n <= light)) for n, count in sizes.items())


def boundary(sizes: dict[int, int], threshold: int = THRESHOLD) -> int:
    """Largest light set: where listing subsets and scanning lists cost least together."""
    def cost(light: int) -> int:
        total = 0
        for n, count in sizes.items():
            if n <= light:
                total += count * sum(comb(n, c) for c in _subset_sizes(n, light, threshold))
            if _is_posted(n, light, threshold):
                total += count * POSTING_COST * _posted(n, threshold)
        return total

    return min(range(MOST_LIGHT + 1), key=lambda light: (cost(light), light))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("text"))


def _rarity(docs: DataFrame, size: int, cells: int) -> bytes:
    """For each cell how often its shingles come up, in half powers of two; a byte a cell."""
    length = min(cells, CELL_BLOCK)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(cells, np.uint32)
        for batch in slices(batches):
            # equal texts of a batch are one set
            sets = [shingles(t, size) for t in set(batch.column("text").to_pylist())]
            met, n = np.unique(np.concatenate([np.zeros(0, np.int64), *sets]) & (cells - 1),
                               return_counts=True)
            counts[met] += n.astype(np.uint32)
        blocks = counts.reshape(-1, length)
        some = np.flatnonzero(blocks.any(1))
        for at in range(0, len(some), 256):
            part = some[at:at + 256]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)),
                 pa.array([pa.compress(_planes(blocks[k]), "zstd", asbytes=True) for k in part],
                          pa.binary())], names=["block", "counts"])

    def total(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(),
                                     batch.column("counts").to_pylist(), strict=True):
                raw = pa.decompress(counts, 4 * length, "zstd", asbytes=True)
                sums.setdefault(block, np.zeros(length, np.int64))
                sums[block] += _from_planes(raw, "<u4")
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()),
             pa.array([np.searchsorted(_LEVELS, x, "right").astype(np.uint8).tobytes()
                       for x in sums.values()], pa.binary())], names=["block", "levels"])

    schema = "block int, {} binary"
    summed = (docs.select("text").mapInArrow(count, schema.format("counts"))
              .repartition("block").mapInArrow(total, schema.format("levels")))
    levels = np.zeros((cells // length, length), np.uint8)
    for row in summed.collect():
        levels[row.block] = np.frombuffer(row.levels, np.uint8)
    return levels.tobytes()


def _planes(column: np.ndarray) -> bytes:
    """All lowest bytes, then all next ones: what is zero lies together."""
    return np.ascontiguousarray(column.view(np.uint8).reshape(len(column), -1).T).tobytes()


def _from_planes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(
        kind).reshape(-1)


def _packed(columns: list[np.ndarray]) -> bytes:
    """Columns of whole numbers, the first by its differences, compressed; their length first."""
    columns = [np.diff(columns[0], prepend=0), *columns[1:]]
    data = pa.compress(b"".join(_planes(c.astype("<i8")) for c in columns), "zstd", asbytes=True)
    return len(columns[0]).to_bytes(8, "little") + data


def _unpacked(data: bytes, width: int) -> list[np.ndarray]:
    size = 8 * int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], width * size, "zstd", asbytes=True)
    columns = [_from_planes(raw[k * size:(k + 1) * size], "<i8") for k in range(width)]
    return [np.cumsum(columns[0]), *columns[1:]]


def _ordered(found: np.ndarray, levels: bytes) -> np.ndarray:
    """Shingles in the global order: the level of their cell, then 56 bits of the hash."""
    level = np.frombuffer(levels, np.uint8)[found & (len(levels) - 1)].astype(np.int64)
    return np.sort((level << _LEVEL_AT) | (found >> 6))


def _usual(levels: bytes) -> int:
    """The level of most cells that hold anything."""
    found = np.bincount(np.frombuffer(levels, np.uint8), minlength=2)[1:]
    return 1 + int(np.searchsorted(np.cumsum(found), found.sum() / 2))


def _sets(docs: DataFrame, size: int, levels, usual: int = 0) -> DataFrame:
    """Id, set size, fingerprint of the set, its shingles above the usual level less the
    others, and the shingles in the global order, packed."""
    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [_ordered(shingles(t, size), levels.value)
                    for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.array([2 * int((s >> _LEVEL_AT > usual).sum()) - len(s) for s in sets],
                          pa.int64()),
                 pa.array([s.astype("<i8").tobytes() for s in sets], pa.binary())],
                names=["id", "n", "print", "central", "packed"])

    return docs.mapInArrow(make, "id long, n long, print binary, central long, packed binary")


def _first_shingles(sets: DataFrame, threshold: int) -> DataFrame:
    """The same with only the shingles that any posting or subset is made of."""
    kept = F.when(F.col("n") <= MOST_LIGHT, F.col("n")).otherwise(_posted_of(threshold))
    return sets.withColumn("packed", F.substring("packed", F.lit(1), (kept * 8).cast("int")))


def _posted_of(threshold: int) -> F.Column:
    n = F.col("n")
    return n - F.floor((n * threshold + 99) / 100) + 1


def _keys(own: np.ndarray, n: int, light: int, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """What one set is listed under, and the places there: shingles, and subsets as
    negative keys without a place."""
    found, places = [np.zeros(0, np.int64)], np.zeros(0, np.int64)
    if _is_posted(n, light, threshold):
        posted = own[:_posted(n, threshold)]
        places = np.flatnonzero(posted >> _LEVEL_AT >= _ALONE)
        found.append(posted[places] >> _UNNAMED_BITS)
    if n <= light:
        found.append(np.array(
            [-1 - (xxhash.xxh3_64_intdigest(own[list(some)].tobytes(), seed=c) >> 1)
             for c in _subset_sizes(n, light, threshold)
             for some in combinations(range(n), c)], np.int64))
    keys = np.concatenate(found)
    return keys, np.pad(places, (0, len(keys) - len(places)))


def _prints(keys: np.ndarray) -> np.ndarray:
    """32 bits of each key, dealt apart from the buckets of lists."""
    return (mixed(keys.astype(np.uint64) ^ _PRINT_SALT) >> np.uint64(32)).astype(np.int64)


def _print_packs(light: int, threshold: int, buckets: int, most: int) -> Callable:
    """Mapper: prints of what classes are listed under, sorted, none more than twice in a
    pack, packed by their range."""
    def pack(held: list[np.ndarray]) -> pa.RecordBatch:
        prints = np.sort(np.concatenate(held))
        third = np.zeros(len(prints), bool)
        third[2:] = prints[2:] == prints[:-2]
        prints = prints[~third]
        ends = np.searchsorted(prints, np.arange(buckets + 1) * (_PRINTS // buckets))
        some = np.flatnonzero(np.diff(ends))
        return pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)),
             pa.array([_packed([prints[ends[k]:ends[k + 1]]]) for k in some], pa.binary())],
            names=["bucket", "data"])

    def packs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches):
            for n, packed in zip(batch.column("n").to_pylist(),
                                 batch.column("packed").to_pylist(), strict=True):
                keys, _ = _keys(np.frombuffer(packed, "<i8"), n, light, threshold)
                held.append(_prints(keys))
                size += len(keys)
                if size >= most:
                    yield pack(held)
                    held, size = [], 0
        if size:
            yield pack(held)
    return packs


def _again(bits: int, buckets: int) -> Callable:
    """Of the prints of one bucket its part of the bits that tell which come up again."""
    def again(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        prints = np.sort(np.concatenate(
            [_unpacked(x, 1)[0] for x in table.column("data").to_pylist()]))
        own = np.zeros(bits // buckets, bool)
        own[prints[1:][prints[1:] == prints[:-1]] // (_PRINTS // bits) - bucket * len(own)] = True
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "data": pa.array(
            [pa.compress(np.packbits(own).tobytes(), "zstd", asbytes=True)], pa.binary())})
    return again


def _met_again(classes: DataFrame, light: int, threshold: int, many: int) -> bytes:
    """Bits that tell by its print whether a key may have a second class; all that have one
    are told."""
    buckets = PRINT_BUCKETS
    while buckets * BUCKET_BYTES < 8 * many and buckets < AGAIN_BITS >> 10:
        buckets *= 2
    schema = "bucket int, data binary"
    found = (classes.select("n", "packed")
             .mapInArrow(_print_packs(light, threshold, buckets, PACKED_PRINTS), schema)
             .groupBy("bucket").applyInArrow(_again(AGAIN_BITS, buckets), schema))
    length = AGAIN_BITS // buckets // 8
    told = np.zeros((buckets, length), np.uint8)
    for row in found.collect():
        told[row.bucket] = np.frombuffer(pa.decompress(row.data, length, "zstd"), np.uint8)
    return told.tobytes()


def _may_meet(keys: np.ndarray, told: bytes) -> np.ndarray:
    bits = np.frombuffer(told, np.uint8)
    at = _prints(keys) // (_PRINTS // (8 * len(bits)))
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


_PACKED = "bucket int, settled boolean, data binary"
_LISTED = "key long, node long, head long, place long, settled boolean"


def _entries(light: int, threshold: int, buckets: int, most: int, told=None) -> Callable:
    """Mapper: what classes are listed under, packed by bucket; with the broadcast ``told``
    only what may have a second class.

    Of the classes under one key in a pack the most central goes to the key's bucket,
    marked if there are others; these go to any bucket.
    """
    def pack(keys: np.ndarray, nodes: np.ndarray, places: np.ndarray,
             central: np.ndarray) -> pa.RecordBatch:
        by = np.lexsort((nodes, -central, keys))
        keys, nodes, places, central = keys[by], nodes[by], places[by], central[by]
        first = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
        heads = np.repeat(nodes[first], np.diff(first, append=len(keys)))
        several = np.add.reduceat(nodes != heads, first) > 0 if len(first) else first
        mark = central << 1
        mark[first] |= several
        rest = np.setdiff1d(np.arange(len(keys)), first)
        out = []

        def deal(at: np.ndarray, bucket: np.ndarray, settled: bool, *columns) -> None:
            order = np.argsort(bucket, kind="stable")
            found, starts = np.unique(bucket[order], return_index=True)
            ends = np.append(starts[1:], len(at))
            for k, start, end in zip(found, starts, ends[:len(starts)], strict=True):
                part = at[order[start:end]]
                out.append((int(k), settled, _packed([c[part] for c in columns])))

        deal(first, _bucket(keys[first], buckets), False, keys, nodes, places, mark)
        deal(rest, _bucket(nodes[rest], buckets), True, keys, nodes, places)
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.bool_()),
             pa.array([x[2] for x in out], pa.binary())], names=["bucket", "settled", "data"])

    def entries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches):
            for node, n, central, packed in zip(
                    *(batch.column(c).to_pylist() for c in ("node", "n", "central", "packed")),
                    strict=True):
                keys, places = _keys(np.frombuffer(packed, "<i8"), n, light, threshold)
                if told is not None:
                    meets = _may_meet(keys, told.value)
                    keys, places = keys[meets], places[meets]
                held.append((keys, np.full(len(keys), node), places,
                             np.full(len(keys), central)))
                size += len(keys)
                if size >= most:
                    yield pack(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    held, size = [], 0
        if size:
            yield pack(*(np.concatenate(x) for x in zip(*held, strict=True)))
    return entries


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    hashed = mixed(keys.astype(np.uint64) ^ _SALT)
    return ((hashed >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _lists(table: pa.Table) -> pa.Table:
    """The lists of one bucket that hold more than one class, a row for each member with
    the list's head; and what else has come, of which only the list is known."""
    parts: dict[bool, list] = {True: [], False: []}
    for settled, data in zip(table.column("settled").to_pylist(),
                             table.column("data").to_pylist(), strict=True):
        width = 3 if settled else 4
        parts[settled].append(_unpacked(data, width))
    none = [np.zeros(0, np.int64)] * 4
    keys, nodes, places, mark = (np.concatenate(x) for x in zip(none, *parts[False], strict=True))
    by = np.lexsort((nodes, -(mark >> 1), keys))
    keys, nodes, places, many = keys[by], nodes[by], places[by], mark[by] & 1
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
    length = np.diff(first, append=len(keys))
    heads = np.repeat(nodes[first], length)
    if len(first):
        several = np.repeat(np.add.reduceat((nodes != heads) | (many > 0), first) > 0, length)
        keys, nodes, heads, places = (x[several] for x in (keys, nodes, heads, places))
    more, more_nodes, more_places = (np.concatenate(x) for x in zip(none[:3], *parts[True],
                                                                    strict=True))
    return pa.table({
        "key": np.concatenate([keys, more]), "node": np.concatenate([nodes, more_nodes]),
        "head": pa.chunked_array([pa.array(heads), pa.nulls(len(more), pa.int64())]),
        "place": np.concatenate([places, more_places]),
        "settled": np.repeat([False, True], [len(keys), len(more)])})


def _headed(lists: DataFrame) -> DataFrame:
    """The lists with the head in every row."""
    heads = lists.where(~F.col("settled") & (F.col("node") == F.col("head")))
    known = lists.where(~F.col("settled")).select("key", "node", "head")
    return known.unionByName(lists.where("settled").select("key", "node").join(
        heads.select("key", "head"), "key"))


def _fitting(a: str, b: str, threshold: int) -> F.Column:
    """Set sizes that can link."""
    return ((F.col(a) * 100 >= F.col(b) * threshold) & (F.col(b) * 100 >= F.col(a) * threshold))


def _linked(pairs: DataFrame, docs: DataFrame, repeated: DataFrame, size: int, threshold: int,
            levels) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets link, compared in full; ``repeated`` are the ids
    that several rows have."""
    pairs = staged(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("id")).unionByName(
        pairs.select(F.col("b").alias("id"))).distinct()

    def made(how: str) -> DataFrame:
        some = docs.join(wanted, "id", "left_semi").join(repeated, "id", how)
        return _sets(some, size, levels).select("id", "print", "packed")

    sets = staged(made("left_anti").unionByName(
        made("left_semi").dropDuplicates(["id", "print"])), "sets")
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("packed").alias("x")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("packed").alias("y")), "b"))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(),
                            strict=True):
                x, y = np.frombuffer(x, "<i8"), np.frombuffer(y, "<i8")
                shared = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(shared >= needed(len(x), len(y), threshold))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def _heads(lists: DataFrame, of_node: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of each set and the fitting head that it meets most often."""
    ranked = Window.partitionBy("node").orderBy(F.desc("met"), "head")
    return (lists.where(F.col("node") != F.col("head"))
            .groupBy("node", "head").agg(F.count("*").alias("met"),
                                         F.min("key").alias("least_key"))
            .join(of_node.select("node", "n"), "node")
            .join(of_node.select(F.col("node").alias("head"), F.col("n").alias("head_n")), "head")
            .where(_fitting("n", "head_n", threshold)
                   & ((F.col("met") * 400 >= F.col("n") * (100 - threshold))
                      | (F.col("least_key") < 0)))
            .withColumn("nth", F.row_number().over(ranked)).where(F.col("nth") == 1)
            .select(F.col("node").alias("a"), F.col("head").alias("b")))


def _several(lists: DataFrame, label: DataFrame) -> DataFrame:
    """The members (key, node, place) of lists that hold several components, with these."""
    labelled = lists.select("key", "node", "place").join(label, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    several = (labelled.groupBy("key").agg(F.min("component").alias("c1"),
                                           F.max("component").alias("c2"))
               .where(F.col("c1") < F.col("c2")).select("key"))
    return staged(labelled.join(several, "key").select("key", "node", "place", "component"),
                  "mixed")


def _open_pairs(left: DataFrame, of_node: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) from different components that may link, by places and number of lists."""
    x, y = (left.join(of_node, "node").select("key", *(
        F.col(c).alias(f"{c}{k}") for c in ("node", "n", "place", "component"))) for k in (1, 2))
    a, b = F.col("n1"), F.col("n2")
    must = F.floor((F.lit(threshold) * (a + b) + 99 + threshold) / (100 + threshold))
    most = F.greatest(a, b)
    # linked sets share so many of the first n - must + so many shingles of either; no
    # more than are posted for both
    least_met = F.greatest(F.lit(1), F.least(
        must - F.floor((most * threshold + 99) / 100) + 1, F.floor((most - must) / MET_PART) + 1))
    # behind a shared shingle no more are shared than either set still has, before it no
    # more than stand there
    room = (F.least("place1", "place2")
            + F.least(a - F.col("place1"), b - F.col("place2")) >= must)
    early = ((F.col("place1") < a - must + least_met) & (F.col("place2") < b - must + least_met))
    pair = x.join(y, "key").where(
        (F.col("node1") < F.col("node2")) & (F.col("component1") != F.col("component2"))
        & _fitting("n1", "n2", threshold)
        & ((F.col("key") < 0) | (early & room))).select(
        F.col("node1").alias("a"), F.col("node2").alias("b"), "key", "n1", "n2")
    met = pair.groupBy("a", "b").agg(F.count("*").alias("met"), F.min("key").alias("least_key"),
                                     F.first("n1").alias("n1"), F.first("n2").alias("n2"))
    return met.where((F.col("least_key") < 0) | (F.col("met") >= least_met)).select("a", "b")


def jaccard_join(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ``n_shingles``, ``class_id`` and ``component_id``.

    ``class_id`` is the least id with the same set, ``component_id`` the least
    id reachable by links; the document's own where there is nothing else.
    """
    spark = docs.sparkSession
    texts = _texts(docs, id_col, text_col)
    rarity = _rarity(texts, shingle, CELLS)
    levels = spark.sparkContext.broadcast(rarity)
    rows = staged(_first_shingles(_sets(texts, shingle, levels, _usual(rarity)), threshold),
                  "shingles")
    small = rows.where(F.col("n").between(1, MOST_LIGHT)).groupBy("n").count().collect()
    sizes = {r.n: r["count"] for r in small}
    light = boundary(sizes, threshold)

    classes = staged(rows.where(F.col("n") > 0).groupBy("print").agg(
        F.min("id").alias("node"), *(F.first(c).alias(c) for c in ("n", "central", "packed"))),
        "classes")
    repeated = staged(rows.groupBy("id").count().where(F.col("count") > 1).select("id"),
                      "repeated-ids")
    posted = classes.where(F.col("n") > MOST_LIGHT).agg(F.sum(_posted_of(threshold)).alias("n"))
    many = int(posted.first().n or 0) + _listed(sizes, light, threshold)
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")),
                  -(-32 * many // BUCKET_BYTES))
    told = spark.sparkContext.broadcast(_met_again(classes, light, threshold, many))
    entries = classes.select("node", "n", "central", "packed").mapInArrow(
        _entries(light, threshold, buckets, PACKED_ROWS, told), _PACKED)
    shared = staged(entries.groupBy("bucket").applyInArrow(_lists, _LISTED), "lists")
    of_node = classes.select("node", "n")

    def linked(pairs: DataFrame) -> DataFrame:
        return staged(_linked(pairs, texts, repeated, shingle, threshold, levels), "links")

    links = linked(_heads(_headed(shared), of_node, threshold))
    # rows that share an id belong together whatever their sets are
    placed = staged(rows.select("id", "n", "print").join(classes.select("print", "node"),
                                                         "print", "left"), "placed")
    known = placed.where(F.col("node").isNotNull())
    several = (known.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("most"))
               .where(F.col("a") < F.col("most")).select("id", "a"))
    same_id = (known.join(several, "id").where(F.col("a") < F.col("node"))
               .select("a", F.col("node").alias("b")).distinct())
    label = components(links.unionByName(same_id))

    # what is left: lists that hold several components
    open_pairs = _open_pairs(_several(shared, label), of_node, threshold)
    label = components(linked(open_pairs).unionByName(
        label.select(F.col("node").alias("a"), F.col("component").alias("b"))))

    named = (placed.join(label, "node", "left")
             .groupBy("id", "n", "print")
             .agg(F.count("*").alias("times"),
                  F.min(F.coalesce("component", "node", "id")).alias("component_id"),
                  F.min(F.coalesce("node", "id")).alias("class_id")))
    # rows without an id, and ids whose other row joins them, come back here
    of_id = named.groupBy("id").agg(F.min("component_id").alias("component_id"))
    known = (named.drop("component_id").join(of_id, "id")
             .withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
             .select("id", F.col("n").alias("n_shingles"), "class_id", "component_id"))
    without = docs.where(F.col(id_col).isNull())
    return (known.unionByName(_unnamed(without, text_col, shingle))
            .withColumn("id", F.col("id").cast(docs.schema[id_col].dataType))
            .withColumnRenamed("id", id_col))


def _unnamed(docs: DataFrame, text_col: str, size: int) -> DataFrame:
    """Rows without an id: set size only."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(shingles(t, size)) for t in batch.column(0).to_pylist()],
                          pa.int64())], names=["n_shingles"])

    none = F.lit(None).cast("long")
    return docs.select(text_bytes(text_col)).mapInArrow(count, "n_shingles long").select(
        none.alias("id"), "n_shingles", none.alias("class_id"), none.alias("component_id"))
