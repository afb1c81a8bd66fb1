"""Benchmark decontamination by a prefix-filtered set join.

A window is ``window`` consecutive words of a benchmark item, or the whole
item if it is shorter. A document contains a window only if it contains all of
its shingles, so one shingle of each window is a prefix that must be met; the
rarest one over all documents is taken, which leaves the fewest candidates.
Documents join the prefixes by shingle; the shingle's place in the window
gives the only possible start (positional bound) and the words needed before
and behind it (length bound); what is left is compared word by word.

The index of windows is broadcast, so its size is checked: benchmark texts are
dealt into blocks of at most ``block_bytes``, and documents pass block after
block without a shuffle.

Cases: null or empty texts have no words and no hits; an item without words
has no window; repeated item rows count once by item id, and a null item id
is listed as the empty string; null and repeated document ids pass through,
one row out for each row in; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, text_bytes

#: Benchmark text whose index one broadcast may hold.
BLOCK_BYTES = 16 << 20

# a-z, 0-9 and all bytes of non-ASCII letters stay, A-Z become a-z, the rest is space
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A
    else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
    for c in range(256))

Shingle = tuple[bytes, ...]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _windows(words: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    return [tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]


def _shingles(window: tuple[bytes, ...]) -> list[Shingle]:
    """Neighbouring word pairs; a window of one word is its own shingle."""
    return list(zip(window, window[1:])) or [window]  # noqa: B905


class WindowIndex:
    """Windows by their rarest shingle: shingle -> place, length -> window -> items."""

    def __init__(self, windows: dict[tuple[bytes, ...], list[str]],
                 frequency: dict[Shingle, int]) -> None:
        self.by_shingle: dict[Shingle, dict[tuple[int, int], dict[bytes, list[str]]]] = {}
        self.single = False
        for window, items in windows.items():
            shingles = _shingles(window)
            at = min(range(len(shingles)),
                     key=lambda i: (frequency.get(shingles[i], 0), shingles[i], i))
            self.single |= len(window) == 1
            places = self.by_shingle.setdefault(shingles[at], {})
            places.setdefault((at, len(window)), {})[b" ".join(window)] = items

    def find(self, words: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        """(start, end, items) of every occurrence of a window."""
        index, n = self.by_shingle, len(words)
        met = [(i, p) for i, p in enumerate(zip(words, words[1:])) if p in index]  # noqa: B905
        if self.single:
            met += [(i, (w,)) for i, w in enumerate(words) if (w,) in index]
        for i, shingle in met:
            for (at, length), windows in index[shingle].items():
                start = i - at
                if start < 0 or start + length > n:
                    continue
                items = windows.get(b" ".join(words[start:start + length]))
                if items is not None:
                    yield start, start + length, items


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _frequencies(docs: DataFrame, wanted: set[Shingle]) -> dict[Shingle, int]:
    """How often each shingle of the benchmark occurs in all documents."""
    known = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, total = known.value, Counter()
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                total.update(p for p in zip(words, words[1:]) if p in of)  # noqa: B905
        yield pa.RecordBatch.from_arrays(
            [pa.array([b" ".join(p) for p in total], pa.binary()),
             pa.array(list(total.values()), pa.int64())], names=["shingle", "n"])

    counted = (docs.mapInArrow(count, "shingle binary, n long")
               .groupBy("shingle").agg(F.sum("n").alias("n")))
    return {tuple(bytes(r.shingle).split(b" ")): r.n for r in counted.toLocalIterator()}


def _index_of(block: DataFrame, docs: DataFrame, window: int) -> WindowIndex:
    windows: dict[tuple[bytes, ...], set[str]] = {}
    for row in block.toLocalIterator():
        for found in _windows(words_of(bytes(row.text)), window):
            windows.setdefault(found, set()).add(row.item)
    wanted = {s for w in windows for s in _shingles(w)}
    frequency = _frequencies(docs, wanted) if windows else {}
    return WindowIndex({w: sorted(items) for w, items in windows.items()}, frequency)


def find_leaks(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = 10,
               text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: ``row``, ``n_words``, ``n_hit``, ``hits`` (word ranges) and ``items``.

    ``row`` has the columns ``keep`` as a struct.

    ``hits`` are the merged ranges of words inside any occurrence of a window,
    as flat pairs start, end; ``items`` the sorted ids, as text, of items with
    an occurring window.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                             text_bytes(item_text).alias("text"))
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    blocks = max(1, -(-size // block_bytes))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"),
                       text_bytes(text_col).alias("text"),
                       F.lit(0).cast("long").alias("n_words"),
                       F.lit(0).cast("long").alias("n_hit"),
                       F.array().cast("array<int>").alias("hits"),
                       F.array().cast("array<string>").alias("items"))
    schema = rows.schema
    only_text = docs.select(text_bytes(text_col).alias("text"))
    for k in range(blocks):
        block = items if blocks == 1 else items.where(
            F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        index = spark.sparkContext.broadcast(_index_of(block, only_text, window))
        rows = rows.mapInArrow(_scan(index, last=k == blocks - 1), schema)
    return rows.drop("text")


def _scan(index, last: bool):
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = index.value
        for batch in slices(batches):
            texts = batch.column("text")
            n_words, n_hit, hits, items = [], [], [], []
            for text, runs, names in zip(texts.to_pylist(), batch.column("hits").to_pylist(),
                                         batch.column("items").to_pylist(), strict=True):
                words = words_of(text or b"")
                found = list(windows.find(words))
                n_words.append(len(words))
                if found:
                    ranges = list(zip(runs[::2], runs[1::2], strict=True))
                    ranges = _merged(ranges + [(a, b) for a, b, _ in found])
                    runs = [x for pair in ranges for x in pair]
                    names = sorted({*names, *(x for _, _, ids in found for x in ids)})
                n_hit.append(sum(runs[1::2]) - sum(runs[::2]))
                hits.append(runs)
                items.append(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"),
                 pa.array([b""] * len(texts), pa.binary()) if last else texts,
                 pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(hits, pa.list_(pa.int32())),
                 pa.array(items, pa.list_(pa.string()))], names=batch.schema.names)
    return scan
