"""Suffix-array dedup by a depth-limited radix sort.

A byte is removed if it lies in a ``window``-byte string that also starts
earlier. Suffixes need ordering only through ``window`` bytes: suffixes that
are equal so far are exactly the repeated windows. The order is found by
passes from the most significant digit on, and a pass only goes on with
suffixes that were not alone in the pass before.

* Which suffixes start: a window contains ``window - gram + 1`` grams; the one
  with the least hash (leftmost on ties) stands for it. Equal windows choose
  the same gram, and neighbouring windows mostly share one, so a run of
  windows goes through the passes as one row.
* First digit: the gram. Rows are dealt by a mixed form of its hash and ordered
  by the hash; a run whose gram occurs once holds no repeated window.
* Second digit: all bytes of the run. Runs that are equal in it are settled
  whole, the earliest stays open, the others are later occurrences.
* Last digit: for the few runs with the same gram but other bytes around it,
  the full ``window`` bytes of each window.

Digits are compared by 128 bits of hash (64 for the gram alone, which only
groups). Nothing is compared by pairs. A run that occurs everywhere reaches a
task once for each batch, and a gram that occurs everywhere in different
surroundings twice for each batch, as the rest is known to need the last digit.

Cases: null and empty texts have 0 bytes; texts shorter than the window lose
nothing; equal ids are one document read twice, so neither row is earlier
than the other at the same start; null ids sort first; ids must be integral;
a very long text is cut into overlapping pieces; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import occurrences as occ
from tidemark.llm.common import slices, staged, text_bytes, total_bytes
from tidemark.llm.hashing import Hash

#: Bytes in the strings that are compared.
WINDOW = 100
#: Bytes in the gram that is the first digit.
GRAM = 32
#: Bytes hashed at once.
PIECE = 1 << 18


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """For each start, the place of the least of ``width`` values, leftmost on ties."""
    place = np.arange(len(values), dtype=np.int32)
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        ahead = values[step:] < values[:-step]
        values = np.where(ahead, values[step:], values[:-step])
        place = np.where(ahead, place[step:], place[:-step])
        reach += step
    return place


def _pieces(batch: pa.RecordBatch, window: int) -> Iterator[tuple[np.ndarray, list[tuple]]]:
    """Joined texts of up to a piece, with (begin, end, first byte's place, row) of each."""
    parts: list[bytes] = []
    spans: list[tuple] = []
    size = 0
    for row, text in enumerate(batch.column("text").to_pylist()):
        for begin in range(0, max(1, len(text) - window + 1), PIECE):
            part = text[begin:begin + PIECE + window - 1]
            if len(part) < window:
                continue
            if parts and size + len(part) > PIECE:
                yield np.frombuffer(b"".join(parts), np.uint8), spans
                parts, spans, size = [], [], 0
            spans.append((size, size + len(part), begin, row))
            parts.append(part)
            size += len(part)
    if parts:
        yield np.frombuffer(b"".join(parts), np.uint8), spans


def _runs(window: int, gram: int):
    """Mapper: the runs of windows that one gram stands for."""
    def rows_of(batch: pa.RecordBatch) -> Iterator[occ.Rows]:
        ids, checks = batch.column("id").to_numpy(), batch.column("check").to_numpy()
        for text, spans in _pieces(batch, window):
            first, second = Hash(text, 1), Hash(text, 2)
            grams = first.grams(gram)
            least = _least(grams, window - gram + 1)
            begin, end, skipped, row = (np.array(x) for x in zip(*spans, strict=True))
            starts = end - begin - window + 1
            at = np.arange(starts.sum()) + np.repeat(begin - (np.cumsum(starts) - starts), starts)
            stands = least[at]
            new = np.ones(len(at), bool)
            new[1:] = (stands[1:] != stands[:-1]) | (at[1:] != at[:-1] + 1)
            head = np.flatnonzero(new)
            low, high = at[head], at[np.append(head[1:], len(at)) - 1]
            piece = np.repeat(np.arange(len(spans)), starts)[head]
            yield {"k1": grams[stands[head]], "k2": second.parts(low, high + window),
                   "id": ids[row[piece]], "check": checks[row[piece]],
                   "at": low - begin[piece] + skipped[piece], "run": high - low + 1}
    return rows_of


def _windows(window: int):
    """Mapper: every window of the runs in ``data``, by all its bytes."""
    def rows_of(batch: pa.RecordBatch) -> Iterator[occ.Rows]:
        ids, checks = batch.column("id").to_pylist(), batch.column("check").to_pylist()
        for k, (text, data) in enumerate(zip(batch.column("text").to_pylist(),
                                             batch.column("data").to_pylist(), strict=True)):
            runs = np.sort(occ.unpacked(data), order="at")
            raw = np.frombuffer(text, np.uint8)
            for begin in range(0, len(raw) - window + 1, PIECE):
                some = runs[(runs["at"] >= begin) & (runs["at"] < begin + PIECE)]
                if not len(some):
                    continue
                low, n = some["at"].astype(np.int64), some["run"].astype(np.int64)
                at = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
                part = raw[begin:begin + PIECE + 2 * window]
                own = at - begin
                yield {"k1": Hash(part, 3).parts(own, own + window),
                       "k2": Hash(part, 4).parts(own, own + window),
                       "id": np.full(len(at), ids[k]), "check": np.full(len(at), checks[k]),
                       "at": at, "run": np.ones(len(at), np.int64)}
    return rows_of


def _kept(window: int):
    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, out = batch.column("text"), ([], [], [])
            for text, data in zip(texts.to_pylist(), batch.column("data").to_pylist(),
                                  strict=True):
                spans, kept = [], text
                if data:
                    found = np.sort(occ.unpacked(data), order="at")
                    low = found["at"].astype(np.int64)
                    high = np.maximum.accumulate(low + found["run"] + (window - 1))
                    head = np.flatnonzero(np.append(True, low[1:] > high[:-1]))
                    low, high = low[head], high[np.append(head[1:], len(low)) - 1]
                    spans = np.stack([low, high], axis=1).reshape(-1).tolist()
                    cuts = [0, *spans, len(text)]
                    kept = b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
                for column, value in zip(out, (len(text), spans, kept), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(out[0], pa.int64()),
                 pa.array(out[1], pa.list_(pa.int64())), pa.array(out[2], pa.binary())],
                names=["key", "n_bytes", "spans", "kept"])
    return keep


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ``n_bytes``, ``spans`` (removed byte ranges) and ``kept`` (bytes).

    ``spans`` are flat pairs start, end of maximal removed runs. ``window``
    may be up to ``gram`` + 255.
    """
    if not gram <= window <= gram + 254:
        raise ValueError("the window must hold the gram and at most 254 bytes more")
    key = F.col(id_col).alias("key")
    texts = docs.select(*occ.identity(id_col, text_bytes(text_col)))
    size = total_bytes(docs, text_col)
    runs = occ.mapped(texts, _runs(window, gram), occ.buckets_for(docs, size), refine=True)
    found = staged(occ.later_places(runs, refine=True), "runs")
    unsettled = found.where(F.col("kind") == occ.OPEN)
    windows = occ.mapped(occ.with_places(texts, unsettled, "inner"), _windows(window),
                         occ.buckets_for(docs, 2 * size))
    settled = staged(occ.later_places(windows), "windows")
    later = found.where(F.col("kind") == occ.LATER).unionByName(settled)
    beside = occ.with_places(docs.select(key, *occ.identity(id_col, text_bytes(text_col))),
                             later, "left")
    kind = docs.schema[id_col].dataType.simpleString()
    return (beside.select("key", "text", "data")
            .mapInArrow(_kept(window), f"key {kind}, n_bytes long, spans array<long>, kept binary")
            .withColumnRenamed("key", id_col))
