"""Quality scores by nearest-neighbour voting over latent-semantic vectors.

A text becomes counts of hashed terms: its words without case and edge
punctuation, the shapes of its words (case, digits, punctuation runs), and how
much of it repeats and how long it is, as banded terms. Counts are weighted by
inverse document frequency over all documents and projected on the leading
singular vectors of the labelled texts. Every document is compared with every
labelled vector by exact cosine products, block by block, and the labels of
the nearest ones vote with their similarity as weight.

The labelled vectors are broadcast, so they are bounded: at most
``labelled_rows`` training rows, those of least hash. Everything else covers
all documents. Labels, language, source and id are never terms.

Cases: a null or empty text has the terms of an empty text and is scored like
any other; rows without a usable label (null, or other than 0 and 1) teach
nothing; a document with several labels teaches each of them; without any
label all scores are 0.5; null and repeated ids pass through, one row out for
each row in; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.llm.common import slices, text_bytes

#: Training rows whose vectors are broadcast.
LABELLED_ROWS = 4000
#: Dimensions of the latent space.
DIMENSIONS = 48
#: Neighbours that vote.
NEIGHBOURS = 25
#: Weights are similarities to this power.
SHARPNESS = 4

_WORDS, _SHAPES, _BANDS = 768, 192, 64
TERMS = _WORDS + _SHAPES + _BANDS
_REMEMBERED = 400_000

_EDGE = re.compile(rb"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+$")
_KINDS = bytes(0x61 if 0x61 <= c <= 0x7A or c >= 0x80 else 0x41 if 0x41 <= c <= 0x5A
               else 0x30 if 0x30 <= c <= 0x39 else c for c in range(256))
_SAME = re.compile(rb"(.)\1+")


class _Terms(dict):
    """The word term and the shape term of a word, worked out at first sight.

    Each task has its own: a worker that is used again, or only kept, holds none.
    """

    def __missing__(self, word: bytes) -> int:
        core = _EDGE.sub(b"", word).lower()
        shape = _SAME.sub(rb"\1", word.translate(_KINDS))[:12]
        pair = (zlib.crc32(core) % _WORDS) * _SHAPES + zlib.crc32(shape) % _SHAPES
        if len(self) >= _REMEMBERED:
            self.clear()
        self[word] = pair
        return pair


def _band(value: float, place: int) -> int:
    """One of 16 bands of a value between 0 and 1, as a term."""
    return _WORDS + _SHAPES + 16 * place + min(15, max(0, int(16 * value)))


def term_counts(texts: list[bytes], known: _Terms | None = None) -> np.ndarray:
    """Counts of all terms, a row for each text; ``known`` are words met before."""
    known = _Terms() if known is None else known
    counts = np.zeros((len(texts), TERMS), np.float32)
    for row, text in enumerate(texts):
        words = text.split()
        n = len(words)
        if n:
            pairs = np.fromiter(map(known.__getitem__, words), np.int64, n)
            counts[row, :_WORDS] = np.bincount(pairs // _SHAPES, minlength=_WORDS)
            counts[row, _WORDS:_WORDS + _SHAPES] = np.bincount(pairs % _SHAPES,
                                                               minlength=_SHAPES)
        lines = [x for x in text.split(b"\n") if x.strip()]
        pieces = [x for x in text.split(b". ") if x.strip()]
        once = len(set(words)) / n if n else 0.0
        weight = max(1, n // 4)  # these count as much as a quarter of the words
        counts[row, _band(min(n, 65535).bit_length() / 16, 0)] = weight
        counts[row, _band(once, 1)] = weight
        counts[row, _band(len(set(lines)) / len(lines) if lines else 0.0, 2)] = weight
        counts[row, _band(len(set(pieces)) / len(pieces) if pieces else 0.0, 3)] = weight
    return counts


class Space(NamedTuple):
    """What a document is scored with."""

    idf: np.ndarray
    axes: np.ndarray      # terms x dimensions
    vectors: np.ndarray   # labelled rows x dimensions, unit length
    labels: np.ndarray


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    rows = np.log1p(counts) * idf
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return (rows / np.where(length > 0, length, 1)).astype(np.float32)


def fit(counts: np.ndarray, labels: np.ndarray, idf: np.ndarray, dimensions: int) -> Space:
    """The latent space of the labelled rows, by the eigenvectors of their term products."""
    rows = weighted(counts, idf)
    _, axes = np.linalg.eigh(rows.T.astype(np.float64) @ rows)
    axes = np.ascontiguousarray(axes[:, ::-1][:, :dimensions]).astype(np.float32)
    return Space(idf, axes, _unit(rows @ axes), labels.astype(np.float32))


def votes(counts: np.ndarray, space: Space, neighbours: int, block: int = 512) -> np.ndarray:
    """Weighted share of label 1 among the nearest labelled rows."""
    own = _unit(weighted(counts, space.idf) @ space.axes)
    found = np.full(len(own), 0.5)
    k = min(neighbours, len(space.labels))
    for at in range(0, len(own) if k else 0, block):
        likeness = own[at:at + block] @ space.vectors.T
        near = np.argpartition(-likeness, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(likeness, near, 1), 0).astype(np.float64)
        weight = weight ** SHARPNESS + 1e-9
        found[at:at + block] = (weight * space.labels[near]).sum(1) / weight.sum(1)
    return np.clip(found, 0.0, 1.0)


def _counted(docs: DataFrame, text_col: str) -> tuple[int, np.ndarray]:
    """Documents, and documents that hold each term, over all of them."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, known = np.zeros(TERMS, np.int64), 0, _Terms()
        for batch in slices(batches):
            texts = batch.column(0).to_pylist()
            for at in range(0, len(texts), 1024):
                held += (term_counts(texts[at:at + 1024], known) > 0).sum(axis=0)
            n += len(texts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, TERMS), pa.int32()),
             pa.array(np.append(n, held), pa.int64())], names=["term", "n"])

    rows = (docs.select(text_bytes(text_col)).mapInArrow(count, "term int, n long")
            .groupBy("term").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(TERMS + 1, np.int64)
    for row in rows:
        counts[row.term + 1] = row.n
    return int(counts[0]), counts[1:]


def _labelled(docs: DataFrame, labels: DataFrame, most: int, id_col: str, text_col: str,
              label_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Term counts and labels of the training rows of least hash, at most ``most``."""
    taught = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).distinct()
    least = (taught.orderBy(F.md5(F.col("id").cast("string")), "id", "label").limit(most))
    found = (docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
             .join(F.broadcast(least), "id")
             .groupBy("id", "label").agg(F.min("text").alias("text")).select("label", "text"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Terms()
        for batch in slices(batches):
            counts = term_counts(batch.column("text").to_pylist(), known)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([row.tobytes() for row in counts], pa.binary())],
                names=["label", "counts"])

    rows = found.mapInArrow(count, "label int, counts binary").collect()
    rows.sort(key=lambda r: (bytes(r.counts), r.label))
    counts = np.array([np.frombuffer(r.counts, np.float32) for r in rows]).reshape(-1, TERMS)
    return counts, np.array([r.label for r in rows], np.float32)


def learn(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS,
          dimensions: int = DIMENSIONS, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> Space:
    """The space that documents are scored in; ``labels`` holds training rows only."""
    n, held = _counted(docs, text_col)
    idf = (np.log((1 + n) / (1 + held)) + 0.1).astype(np.float32)
    counts, known = _labelled(docs, labels, labelled_rows, id_col, text_col, label_col)
    return fit(counts, known, idf, dimensions)


def score(docs: DataFrame, space: Space, keep: list[str], text_col: str = "text",
          neighbours: int = NEIGHBOURS) -> DataFrame:
    """``row`` (the columns ``keep`` as a struct) and ``score`` of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(space)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"),
                       text_bytes(text_col).alias("text"))

    def vote(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Terms()
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            scores = [votes(term_counts(texts[at:at + 1024], known), shared.value, neighbours)
                      for at in range(0, len(texts), 1024)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.concatenate([np.zeros(0), *scores]))],
                names=["row", "score"])

    return rows.mapInArrow(vote, StructType([rows.schema["row"],
                                             StructField("score", DoubleType())]))
