"""Which occurrences of a string are not its first, over all documents at once.

A mapper names strings by two 64-bit hashes and says where they start. Its
rows travel packed: for each half a million rows and bucket one row holds the
columns as bytes, which costs a fraction of a row for each occurrence. Buckets
are dealt by a mixed form of the first hash, as mappers that choose least
hashes leave it far from even. Before that, the task settles what it can alone:
of equal strings only the earliest goes to the bucket, the others are later ones
whatever the rest of the corpus holds. So a string that fills a third of the
corpus reaches its bucket a few times for each task, not once for each
occurrence. Where strings with one first hash and several second ones are asked
for, a task that holds three or more of them sends two to the bucket, which
learns from these that there are several, and knows the rest to be open.

Earlier means smaller document id, then smaller start; occurrences with equal
id and start (repeated rows) are neither earlier nor later than one another.
A document is known by its id and a checksum of its text, so rows that share
an id but not a text keep their own results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices
from tidemark.llm.hashing import mixed

#: Stands for a null document id, which sorts first.
NO_ID = -(1 << 63)
#: Occurrences that a task holds before it packs them.
PACKED_ROWS = 1 << 19
#: Packed bytes that one bucket should hold; settling takes some six times as much.
BUCKET_BYTES = 8 << 20

_KINDS = (("k1", "<u8"), ("k2", "<u8"), ("id", "<i8"), ("check", "<u4"), ("at", "<u4"),
          ("run", "u1"))
_ROW = sum(np.dtype(kind).itemsize for _, kind in _KINDS)
_PLACE = np.dtype([("at", "<u4"), ("run", "u1")])
PACKED = "bucket int, kind int, id long, check long, data binary"
PLACES = "kind int, id long, check long, data binary"

Rows = dict[str, np.ndarray]


def identity(id_col: str, text: F.Column) -> list[F.Column]:
    """Columns ``id``, ``check`` and ``text`` (bytes) that the mappers work on."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
            F.crc32(text).alias("check"), text.alias("text")]


def buckets_for(df: DataFrame, packed_bytes: int) -> int:
    """Enough buckets for even tasks, and for none to hold much more than the bound."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(4 * tasks, -(-packed_bytes // BUCKET_BYTES))


def _take(rows: Rows, at: np.ndarray) -> Rows:
    return {name: column[at] for name, column in rows.items()}


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Where a new group starts in sorted keys."""
    new = np.zeros(len(keys[0]), bool)
    if len(new):
        new[0] = True
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
    return new


def _repeated(key: np.ndarray) -> np.ndarray:
    """Indices of rows whose key occurs more than once, sorted by key."""
    order = np.argsort(key, kind="stable")
    new = _groups(key[order])
    last = np.append(new[1:], True)
    return order[~(new & last)]


def split_later(rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Indices of first and of later occurrences of each (k1, k2)."""
    with np.errstate(over="ignore"):
        both = rows["k1"] * np.uint64(0x9E3779B97F4A7C15) + rows["k2"]
    again = _repeated(both)
    some = _take(rows, again)
    again = again[np.lexsort((some["at"], some["id"], some["k2"], some["k1"]))]
    some = _take(rows, again)
    new = _groups(some["k1"], some["k2"])
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(new) else np.zeros(0, np.int64)
    later = (some["id"] != some["id"][head]) | (some["at"] != some["at"][head])
    late = np.zeros(len(both), bool)
    late[again[later]] = True
    return np.flatnonzero(~late), np.flatnonzero(late)


def places(rows: Rows, kind: int, bucket: Callable | None = None) -> list[tuple]:
    """A packed row for each document among ``rows``."""
    if not len(rows["id"]):
        return []
    rows = _take(rows, np.lexsort((rows["at"], rows["check"], rows["id"])))
    data = np.empty(len(rows["id"]), _PLACE)
    data["at"], data["run"] = rows["at"], rows["run"]
    starts = np.flatnonzero(_groups(rows["id"], rows["check"]))
    out = []
    for a, b in zip(starts, np.append(starts[1:], len(data)), strict=True):
        own = (kind, int(rows["id"][a]), int(rows["check"][a]), data[a:b].tobytes())
        out.append(own if bucket is None else (bucket(own[1]), *own))
    return out


def unpacked(blobs: Iterable[bytes]) -> np.ndarray:
    """Places (``at``, ``run``) out of packed rows."""
    return np.frombuffer(b"".join(blobs), _PLACE)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_PACKED_SCHEMA = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("id", pa.int64()),
                            ("check", pa.int64()), ("data", pa.binary())])
_PLACES_SCHEMA = pa.schema(list(_PACKED_SCHEMA)[1:])
_OCCURRENCES, LATER, OPEN = 0, 1, 2


def _beyond_two(key: np.ndarray) -> np.ndarray:
    """Whether a row has two rows of the same key before it."""
    again = _repeated(key)
    new = np.flatnonzero(_groups(key[again]))
    nth = np.arange(len(again)) - np.repeat(new, np.diff(np.append(new, len(again))))
    beyond = np.zeros(len(key), bool)
    beyond[again[nth >= 2]] = True
    return beyond


def pack(rows: Rows, buckets: int, refine: bool = False) -> pa.RecordBatch:
    """What a batch sends on: its first occurrences by bucket, and those it has settled.

    With ``refine`` no more than two rows with one ``k1`` go to a bucket.
    """
    def passing(doc: int) -> int:
        return doc % buckets

    first, late = split_later(rows)
    out = places(_take(rows, late), LATER, passing)
    rows = _take(rows, first)
    if refine:
        open_ = _beyond_two(rows["k1"])
        out += places(_take(rows, np.flatnonzero(open_)), OPEN, passing)
        rows = _take(rows, np.flatnonzero(~open_))
    digit = ((mixed(rows["k1"]) >> np.uint64(32)) * np.uint64(buckets)
             >> np.uint64(32)).astype(np.int64)
    order = np.argsort(digit, kind="stable")
    edges = np.searchsorted(digit[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        own = order[edges[b]:edges[b + 1]]
        data = b"".join(rows[name][own].astype(kind).tobytes() for name, kind in _KINDS)
        out.append((int(b), _OCCURRENCES, None, None, data))
    return _batch(out, _PACKED_SCHEMA)


def _unpack(blobs: pa.ChunkedArray) -> Rows:
    parts: dict[str, list[np.ndarray]] = {name: [np.zeros(0, kind)] for name, kind in _KINDS}
    for blob in (value.as_buffer() for value in blobs):
        n, at = len(blob) // _ROW, 0
        for name, kind in _KINDS:
            parts[name].append(np.frombuffer(blob, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return {name: np.concatenate(found) for name, found in parts.items()}


def later_places(packed: DataFrame, refine: bool = False) -> DataFrame:
    """Places of later occurrences by document (kind ``LATER``).

    With ``refine``, also the first occurrences of strings whose ``k1`` has
    several ``k2`` (kind ``OPEN``): equal in the first digit, not in all.
    """
    def settle(group: pa.Table) -> pa.Table:
        kinds = group.column("kind").to_numpy()
        known = group.filter(pa.array(kinds != _OCCURRENCES)).select(_PLACES_SCHEMA.names)
        rows = _unpack(group.column("data").filter(pa.array(kinds == _OCCURRENCES)))
        del group
        first, late = split_later(rows)
        out = places(_take(rows, late), LATER)
        if refine:
            rows = _take(rows, first)
            rows = _take(rows, _repeated(rows["k1"]))
            order = np.lexsort((rows["k2"], rows["k1"]))
            rows = _take(rows, order)
            new1, new2 = _groups(rows["k1"]), _groups(rows["k1"], rows["k2"])
            kinds_of = np.add.reduceat(new2, np.flatnonzero(new1)) if len(new1) else new1
            several = (kinds_of > 1)[np.cumsum(new1) - 1] if len(new1) else new1
            out += places(_take(rows, np.flatnonzero(several)), OPEN)
        return pa.concat_tables([known.cast(_PLACES_SCHEMA),
                                 pa.Table.from_batches([_batch(out, _PLACES_SCHEMA)])])

    return packed.groupBy("bucket").applyInArrow(settle, PLACES)


def by_document(found: DataFrame) -> DataFrame:
    """One row for each document: ``id``, ``check``, ``data`` (list of packed places)."""
    return found.groupBy("id", "check").agg(F.collect_list("data").alias("data"))


def with_places(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Documents beside their places; no sort, as the places are the smaller side."""
    return docs.join(by_document(found).hint("shuffle_hash"), ["id", "check"], how)


def mapped(docs: DataFrame, rows_of: Callable[[pa.RecordBatch], Iterator[Rows]],
           buckets: int, refine: bool = False) -> DataFrame:
    """Packed rows of a mapper that gives the occurrences in a batch of documents."""
    def packed(parts: list[Rows]) -> pa.RecordBatch:
        return pack({name: np.concatenate([p[name].astype(kind) for p in parts])
                     for name, kind in _KINDS}, buckets, refine)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[Rows] = []
        held = 0
        for batch in slices(batches):
            for rows in rows_of(batch):
                parts.append(rows)
                held += len(rows["id"])
                if held >= PACKED_ROWS:
                    yield packed(parts)
                    parts, held = [], 0
        if parts:
            yield packed(parts)

    return docs.mapInArrow(run, PACKED)
