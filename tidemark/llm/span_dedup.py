"""Substring dedup by sliding sentence spans.

A text is cut into sentences; every run of ``run`` consecutive sentences is
hashed, the hashes meet over all documents, and each run that also occurs
earlier (smaller id, or same document and earlier sentence) is a repeated
span. Sentences covered by any such span are removed. Overlaps count, and runs
are judged on the input, not on what is left.

A sentence ends behind ``.``, ``!`` or ``?`` before white space, or at a line
break. One of more than ``most_words`` words is cut. Up to three times as many
words are counted off from its start, as passages meet again at its end. In a
longer one the words decide, so that equal passages get equal cuts wherever
they stand: it is cut where the hash of the two words around the cut is least
among the ``most_words // 2`` places on either side, and a part that is still
too long where that hash is least in the second half of its next
``most_words``. Sentences are compared without the white space around and
between their words, letter case ignored for A-Z.

Cases: null and empty texts have no sentences; a text of fewer sentences than
a run is left as it is; equal ids are one document read twice, so neither row
is earlier; null ids sort first; ids must be integral; other columns are not
read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import occurrences as occ
from tidemark.llm.common import slices, staged, text_bytes, total_bytes

#: Sentences in a span.
RUN = 3
#: Most words of a sentence; longer ones are cut.
MOST_WORDS = 8
#: Sentences of up to so many times the most words are cut by counting.
COUNTED = 3


def _sentence(most_words: int) -> re.Pattern[bytes]:
    """White space, up to ``most_words`` words of which the last may end it, line by line."""
    blank, word = rb"[ \t\x0b\x0c]", rb"[^ \t\r\n\x0b\x0c]"
    inner = word + rb"*[^ \t\r\n\x0b\x0c.!?]" + blank + rb"+"
    return re.compile(rb"\s*(?:" + inner + rb"){0,%d}" % (most_words - 1) + word + rb"+")


def sentences(text: bytes, most_words: int = MOST_WORDS) -> list[tuple[int, int]]:
    """Byte ranges of the sentences; each has the white space before it."""
    found: list[tuple[int, int]] = []
    parts: list[tuple[int, int]] = []  # of one sentence, by counting
    for a, b in (m.span() for m in _sentence(most_words).finditer(text)):
        if parts and (text[a - 1] in b".!?" or _BREAK.match(text, a)):
            found += _recut(text, parts, most_words)
            parts = []
        parts.append((a, b))
    return found + _recut(text, parts, most_words)


_BREAK = re.compile(rb"[ \t\x0b\x0c]*[\r\n]")
_WORD = re.compile(rb"[^ \t\r\n\x0b\x0c]+")


def _recut(text: bytes, parts: list[tuple[int, int]], most_words: int) -> list[tuple[int, int]]:
    """The parts of a sentence; those of a long one where its words say."""
    if len(parts) <= COUNTED:
        return parts
    start, end = parts[0][0], parts[-1][1]
    ends = [m.end() for m in _WORD.finditer(text, start, end)]
    cuts = [start, *(ends[k] for k in _cuts(text[start:end].lower().split(), most_words)), end]
    return list(zip(cuts, cuts[1:]))  # noqa: B905


def _cuts(words: list[bytes], most_words: int) -> list[int]:
    """Words behind which a long sentence is cut."""
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    worth = (own[:-1] ^ (own[1:] >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + own[1:]
    worth = (worth ^ (worth >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    worth ^= worth >> np.uint64(32)
    half = most_words // 2
    least = np.zeros(len(worth), bool)
    middle = worth[half:len(worth) - half]
    least[half:len(worth) - half] = True
    for k in range(1, half + 1):  # of equal ones, the first
        least[half:len(worth) - half] &= (middle < worth[half - k:len(worth) - half - k]) \
            & (middle <= worth[half + k:len(worth) - half + k])
    found, at, values = [], -1, worth.tolist()
    for stop in [*np.flatnonzero(least).tolist(), len(words) - 1]:
        while stop - at > most_words:
            at = min(range(at + half + 1, at + most_words + 1), key=values.__getitem__)
            found.append(at)
        if stop < len(words) - 1:
            found.append(stop)
        at = stop
    return found


def _hashes(text: bytes, ranges: list[tuple[int, int]]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(b" ".join(text[a:b].lower().split()))
                     for a, b in ranges], np.uint64)


def _spans(run: int, most_words: int):
    """Mapper: the runs of sentences of each text."""
    def rows_of(batch: pa.RecordBatch) -> Iterator[occ.Rows]:
        ids, checks = batch.column("id").to_pylist(), batch.column("check").to_pylist()
        for doc, check, text in zip(ids, checks, batch.column("text").to_pylist(), strict=True):
            own = _hashes(text, sentences(text, most_words))
            n = len(own) - run + 1
            if n < 1:
                continue
            k1, k2 = np.full(n, 1, np.uint64), np.full(n, 2, np.uint64)
            for k in range(run):
                k1 = (k1 ^ own[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
                k1 ^= k1 >> np.uint64(31)
                k2 = (k2 ^ own[k:k + n] ^ (own[k:k + n] >> np.uint64(27))) \
                    * np.uint64(0xD6E8FEB86659FD93)
                k2 ^= k2 >> np.uint64(30)
            yield {"k1": k1, "k2": k2, "id": np.full(n, doc), "check": np.full(n, check),
                   "at": np.arange(n), "run": np.ones(n, np.int64)}
    return rows_of


def _cut(run: int, most_words: int):
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: tuple[list, ...] = ([], [], [], [])
            for text, data in zip(batch.column("text").to_pylist(),
                                  batch.column("data").to_pylist(), strict=True):
                ranges = sentences(text, most_words)
                gone = np.zeros(len(ranges) + 1, bool)
                for k in range(run if data else 0):
                    gone[occ.unpacked(data)["at"] + k] = True
                kept = text
                if gone.any():
                    rest = text[ranges[-1][1]:] if ranges else text
                    kept = b"".join(text[a:b] for (a, b), g in zip(ranges, gone) if not g) + rest  # noqa: B905
                for column, value in zip(out, (len(ranges), int(gone.sum()),
                                               np.flatnonzero(gone).tolist(),
                                               kept.decode("utf-8")), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                 pa.array(out[2], pa.list_(pa.int32())), pa.array(out[3], pa.string())],
                names=["key", "n_sentences", "n_removed", "removed", "kept"])
    return cut


def remove_spans(docs: DataFrame, run: int = RUN, most_words: int = MOST_WORDS,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, ``n_sentences``, ``n_removed``, ``removed`` (places) and ``kept`` text."""
    texts = docs.select(*occ.identity(id_col, text_bytes(text_col)))
    size = total_bytes(docs, text_col)
    # a packed row takes 33 bytes: about a byte for each of prose, but 16 for one-word lines
    rows = occ.mapped(texts, _spans(run, most_words), occ.buckets_for(docs, 4 * size))
    later = staged(occ.later_places(rows), "spans")
    beside = occ.with_places(
        docs.select(F.col(id_col).alias("key"), *occ.identity(id_col, text_bytes(text_col))),
        later, "left")
    kind = docs.schema[id_col].dataType.simpleString()
    return (beside.select("key", "text", "data")
            .mapInArrow(_cut(run, most_words), f"key {kind}, n_sentences long, n_removed long, "
                                               "removed array<int>, kept string")
            .withColumnRenamed("key", id_col))
