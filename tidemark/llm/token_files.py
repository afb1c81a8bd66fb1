"""Token ids as range-coded files in document order, and reading them back.

Texts are dealt by ranges of document id and sorted, each task encodes its
range with the tokenizer and cuts the ids into groups of whole documents;
:mod:`tidemark.llm.range_coder` codes a group as blocks that start from an
empty model and carry a checksum each. A group is one record of a Parquet
file: its place (shard, group), the index of its documents, the frequency list
and the coded blocks. Spark's committer publishes the files, so a lost
executor or a repeated task leaves no half-written block.

Texts are cut where the byte-level splitter cuts, by the kinds of their bytes:
many texts at once in numpy. Arrow numbers the distinct parts, each of which is
encoded once while its task remembers it, and the ids of a text are gathered
from those of its parts. Parts of plain letters, digits and signs go to the
library many to a word, where its vocabulary proves that no merge leads from
one to the next. Runs without white space that hold anything else are parts as
a whole; the tokenizer cuts them. Texts that hold a special string or white
space beyond ASCII, and all texts where the file asks for another splitter, are
encoded whole.

Cases: a null or empty text has the end id only; equal ids are ordered by
the hash of their text, null ids come first; other columns are not read; an
empty table gives no records and no rows.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from tidemark.llm import range_coder
from tidemark.llm.common import freed_shuffles, slices, total_bytes
from tidemark.llm.token_counts import open_tokenizer

#: Ids after which a group is closed at the next end of a document.
GROUP_IDS = 10 << 20
#: Text that one task encodes; its ids make one group as a rule, since numpy's
#: steps through a group take nearly as long for a small one.
SHARD_BYTES = 20 << 20
#: Text that is cut at once.
CUT_BYTES = 4 << 20
#: Text whose distinct parts are told apart at once: all that a task has, as a rule.
PARTED_BYTES = 24 << 20
#: Parts that a task remembers before it starts afresh.
REMEMBERED_PARTS = 400_000
#: Parts that the library gets as one word are about so long together; it looks up
#: words of less than 256 letters in a store that such would only fill.
WORD_BYTES = 500

# Kinds of bytes; 0xFF, which UTF-8 doesn't have, stands after each text.
_WHITE, _LETTER, _DIGIT, _SIGN, _HARD, _END = range(6)
_KIND = np.full(256, _HARD, np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _LETTER
_KIND[0x09:0x0E] = _KIND[0x20] = _WHITE
_KIND[0xFF] = _END
# Parts of these bytes only, with the one blank before them, hold no other white space.
_PLAIN = np.isin(np.arange(6), (_LETTER, _DIGIT, _SIGN))


def splits_by_bytes(path: str) -> bool:
    """Whether the file's own settings are those the pieces are cut by."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    first = spec.get("pre_tokenizer") or {}
    return (spec.get("normalizer") is None and first.get("type") == "ByteLevel"
            and first.get("use_regex") is True and first.get("add_prefix_space") is False
            and not any(x["lstrip"] or x["rstrip"] or x["single_word"]
                        for x in spec.get("added_tokens", [])))


def _kinds(raw: np.ndarray) -> np.ndarray:
    """The kind of each byte; a run without white space that holds a hard one is hard."""
    kind = np.frombuffer(bytearray(raw).translate(_KIND.tobytes()), np.uint8)
    for lead, letters in ((0xC2, (0xAA, 0xB5, 0xBA)), (0xC3, None)):
        at = np.flatnonzero(raw == lead)
        if len(at):
            after = raw[at + 1]
            own = np.isin(after, letters) if letters else (after != 0x97) & (after != 0xB7)
            kind[at] = kind[at + 1] = np.where(own, np.uint8(_LETTER), np.uint8(_HARD))
    hard = np.flatnonzero(kind == _HARD)
    if len(hard):
        solid = (kind != _WHITE) & (kind != _END)
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        run = np.cumsum(first, dtype=np.int32)
        marked = np.zeros(int(run[-1]) + 1, bool)
        marked[run[hard]] = True
        kind[solid & marked[run]] = _HARD
    return kind


def _starts(raw: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where the byte-level splitter begins a part."""
    end, white = kind == _END, kind == _WHITE
    start = end.copy()
    start[0] = True
    start[1:] |= kind[1:] != kind[:-1]
    # the last of some white space stands alone, a blank goes to what follows
    turn = np.flatnonzero(white[:-1] & ~(white | end)[1:]) + 1
    start[turn - 1] = True
    start[turn[raw[turn - 1] == 0x20]] = False
    quote = np.flatnonzero((raw == 0x27) & start & (kind == _SIGN))
    if len(quote):
        one, two = raw[quote + 1], raw[np.minimum(quote + 2, len(raw) - 1)]
        short = np.isin(one, list(b"stmd"))
        long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))
                | (one == ord("l")) & (two == ord("l")))
        start[quote[short | long] + 1] = False
        start[quote[short] + 2] = True
        start[quote[long] + 3] = True
    return np.flatnonzero(start)


def _wide_space(raw: np.ndarray) -> np.ndarray:
    """Where white space of several bytes is."""
    at = np.flatnonzero((raw >= 0xC2) & (raw < 0xE4) & (raw != 0xC3))
    a, b, c = raw[at], raw[at + 1], raw[np.minimum(at + 2, len(raw) - 1)]
    found = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    found |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)
    found |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    found |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)
    found |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
    return at[found]


class _Cut(NamedTuple):
    """Texts that were cut at once."""

    parts: pa.BinaryArray     # of all texts, a byte 0xFF as the last one of each
    last: np.ndarray          # which parts those are
    whole: dict[int, np.ndarray]  # ids of texts that were not cut, which have no other parts


class _Pieces:
    """Ids of texts; each distinct part of them is encoded once, while remembered."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task on each core
        self.tokenizer = open_tokenizer(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut = splits_by_bytes(path)
        letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # bytes from 0x80 as the last ones of characters, then the two that lead such
        self.spelt = {c: letters.pre_tokenize_str(chr(c))[0][0][-1] for c in range(0xC0)}
        self.spelt |= {c[0]: letters.pre_tokenize_str(c.decode())[0][0][0]
                       for c in (b"\xc2\xa1", b"\xc3\xa1")}
        self.letter = np.array([ord(self.spelt.get(c, "\0")) for c in range(256)], "<u2")
        self.bare = Tokenizer(self.model)
        vocabulary = self.tokenizer.get_vocab()
        blank, feed = self.spelt[0x20], self.spelt[0x0A]
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[n for token, n in vocabulary.items() if token[0] == blank]] = True
        self.feed = vocabulary.get(feed, -1)
        self.joins = merges_alone(self.model) and self.feed >= 0 and not any(
            (blank in token.lstrip(blank) or feed in token and token.strip(feed))
            and not self._spaced(token) for token in vocabulary)
        self.forget()

    def _spaced(self, token: str) -> bool:
        """Whether a vocabulary string holds white space of several bytes, as no plain part does."""
        byte = {letter: c for c, letter in self.spelt.items()}
        return len(_wide_space(np.array([byte.get(c, 0) for c in token] + [0xFF] * 2, np.uint8))) > 0

    def forget(self) -> None:
        self.parts = pa.array([], pa.binary())
        self.coded = pa.array([], pa.large_binary())  # their ids, unsigned 32-bit

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _one(self, part: bytes, plain: bool) -> np.ndarray:
        if not plain:
            return self.whole(part.decode())
        spelt = "".join(map(self.spelt.__getitem__, part))
        return np.array([t.id for t in self.model.tokenize(spelt)], np.uint32)

    def _many(self, parts: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain parts that begin with a blank, and how many each has.

        Many make one word for the library, since no merge leads over such a
        blank; the ids tell where each part begins.
        """
        if self.joins:
            ids = self._words(*_flat(parts))
            at = np.flatnonzero(self.opens[ids])
            if len(at) == len(parts) and not at[0]:
                return ids, np.diff(at, append=len(ids))
        return _joined([self._one(part, True) for part in parts.to_pylist()])

    def _others(self, parts: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """As ``_many`` for plain parts that begin with no blank; line feeds, over which
        no merge leads to them either, stand between."""
        if self.joins:
            ids = self._words(*_flat(_followed(parts, b"\n")))
            at = np.flatnonzero(ids == self.feed)
            if len(at) == len(parts):
                return ids[ids != self.feed], np.diff(at, prepend=-1) - 1
        return _joined([self._one(part, True) for part in parts.to_pylist()])

    def _words(self, raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Ids of plain parts that are joined to words."""
        spelt = self.letter.take(raw)
        last = np.unique(np.searchsorted(ends, np.arange(WORD_BYTES, len(raw), WORD_BYTES)))
        words = np.split(spelt, ends[last])
        ids = []
        for at in range(0, len(words), 16):
            own = [x.tobytes().decode("utf-16-le") for x in words[at:at + 16]]
            ids += [np.array(x.ids, np.uint32) for x in self.bare.encode_batch_fast(
                own, add_special_tokens=False)]
        return np.concatenate(ids)

    def _remember(self, parts: pa.BinaryArray, ids: np.ndarray, sizes: np.ndarray) -> None:
        offsets = np.append(0, 4 * np.cumsum(sizes))
        coded = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(parts), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
        self.parts = pa.concat_arrays([self.parts, parts])
        self.coded = pa.concat_arrays([self.coded, coded])

    def _learn(self, parts: pa.BinaryArray, end: int) -> np.ndarray:
        """Encodes and remembers new parts; gives the order they are remembered in."""
        joined, ends = _flat(_followed(parts, b"\xff"))
        begin = np.append(0, ends[:-1])
        inner = (joined[begin] == 0x20) & (ends - begin > 2)
        plain = _PLAIN[_kinds(joined)[begin + inner]]
        blank = plain & inner
        if blank.any():
            own = parts.filter(pa.array(blank))
            self._remember(own, *self._many(own))
        other = plain & ~inner
        if other.any():
            own = parts.filter(pa.array(other))
            self._remember(own, *self._others(own))
        rest = np.flatnonzero(~plain)
        if len(rest):
            own = parts.take(pa.array(rest))
            self._remember(own, *_joined([
                np.array([end], np.uint32) if part == b"\xff" else self._one(part, False)
                for part in own.to_pylist()]))
        return np.concatenate([np.flatnonzero(blank), np.flatnonzero(other), rest])

    def encoded(self, text: str) -> bytes:
        return self.whole(text).astype("<u4").tobytes()

    def of(self, text: str) -> bytes:
        return self.of_all(pa.array([text]), 0)[0][:-1].astype("<u4").tobytes()

    def of_all(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, ``end`` after each, and how many each has."""
        return self.of_cuts([self.cut_up(texts)], end)

    def cut_up(self, texts: pa.Array) -> _Cut:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        texts.validate(full=True)
        apart = np.zeros(len(texts), bool) if self.cut else np.ones(len(texts), bool)
        for string in self.special:
            apart |= pc.match_substring(texts, string).to_numpy(zero_copy_only=False)
        joined = _followed(texts.cast(pa.large_binary()), b"\xff")
        raw, ends = _flat(joined)
        wide = _wide_space(raw)
        apart[np.searchsorted(ends, wide, "right")] = True
        if apart.any():
            raw, _ = _flat(pc.if_else(pa.array(apart), pa.scalar(b"\xff", pa.large_binary()),
                                      joined))
        kind = _kinds(raw)
        starts = _starts(raw, kind)
        last = np.flatnonzero(kind[starts] == _END)
        offsets = np.append(starts, len(raw)).astype(np.int32)
        parts = pa.BinaryArray.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        return _Cut(parts, last, {k: self.whole(texts[k].as_py())
                                  for k in np.flatnonzero(apart).tolist()})

    def of_cuts(self, cuts: list[_Cut], end: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``of_all``; the list is emptied, since the cuts hold much."""
        if len(self.parts) > REMEMBERED_PARTS:
            self.forget()
        met = pa.chunked_array([cut.parts for cut in cuts]).dictionary_encode()
        texts = [(cut.last, cut.whole) for cut in cuts]
        cuts.clear()
        parts = met.chunk(met.num_chunks - 1).dictionary
        number = pc.index_in(parts, value_set=self.parts).fill_null(-1).to_numpy().copy()
        new = np.flatnonzero(number < 0)
        if len(new):
            known = len(self.parts)
            number[new[self._learn(parts.take(pa.array(new)), end)]] = np.arange(
                known, known + len(new))
        coded = self.coded.take(pa.array(number))
        out, lengths = [], []
        for (last, whole), chunk in zip(texts, met.chunks, strict=True):
            raw, ends = _flat(coded.take(chunk.indices))
            ids, ends = raw.view(np.uint32), ends[last] >> 2
            sizes = np.diff(ends, prepend=0)
            done = 0
            for k, own in whole.items():
                out += [ids[done:ends[k] - 1], own]
                done = ends[k] - 1
                sizes[k] += len(own)
            out.append(ids[done:])
            lengths.append(sizes)
        return np.concatenate(out), np.concatenate(lengths)


def merges_alone(model: object) -> bool:
    """Whether nothing but its merges decides what a word of the model becomes."""
    return (isinstance(model, models.BPE) and not model.ignore_merges and not model.dropout
            and not model.continuing_subword_prefix and not model.end_of_word_suffix)


def _joined(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(ids), np.array([len(x) for x in ids])


_open: dict[str, _Pieces] = {}


def _pieces(path: str) -> _Pieces:
    if path not in _open:
        _open[path] = _Pieces(path)
    return _open[path]


def _followed(texts: pa.Array, by: bytes) -> pa.Array:
    """Each text with some bytes behind it."""
    return pc.binary_join_element_wise(
        texts, *(pa.scalar(x, texts.type) for x in (by, b"")))


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each ends."""
    kind = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    ends = np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1]
    return np.frombuffer(texts.buffers()[2], np.uint8)[ends[0]:ends[-1]], ends[1:] - ends[0]


def _cuts(texts: pa.Array) -> Iterator[slice]:
    """Texts that are cut together."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    begin = held = 0
    for k, size in enumerate(sizes.tolist()):
        if k > begin and held + size > CUT_BYTES:
            yield slice(begin, k)
            begin = k
            held = 0
        held += size
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def _parted(pieces: _Pieces, batches: Iterable[pa.RecordBatch]
            ) -> Iterator[tuple[pa.Array, list[_Cut]]]:
    """Document ids, and their texts cut up, so many that their parts are told apart together."""
    ids: list[pa.Array] = []
    cuts: list[_Cut] = []
    held = 0
    for batch in batches:
        for at in _cuts(batch.column("text")):
            own = batch.slice(at.start, at.stop - at.start)
            ids.append(own.column("id"))
            cuts.append(pieces.cut_up(own.column("text")))
            held += cuts[-1].parts.buffers()[2].size
            if held >= PARTED_BYTES:
                yield pa.concat_arrays(ids), cuts
                ids, cuts, held = [], [], 0
    if ids:
        yield pa.concat_arrays(ids), cuts


def _record_type(id_type: str) -> str:
    return (f"shard int, part int, n_ids long, doc_ids array<{id_type}>, lengths array<int>, "
            "ranks binary, blocks binary, words binary")


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int,
                 id_col: str = "doc_id", text_col: str = "text",
                 shard_bytes: int = SHARD_BYTES) -> None:
    """Write the ids of all texts, ``end_id`` after each, below ``path``.

    ``tokenizer_path`` must open on every executor.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shards = max(1, -(-total_bytes(rows) // shard_bytes))
    id_type = rows.schema["id"].dataType.simpleString()

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(tokenizer_path)
        pieces.forget()
        shard = TaskContext.get().partitionId()
        part, held = 0, 0
        ids: list[pa.Array] = []
        lengths: list[np.ndarray] = []
        coded: list[np.ndarray] = []

        def record() -> pa.RecordBatch:
            whole = [np.concatenate(coded)]
            coded.clear()
            group = range_coder.encode(whole.pop())
            docs = pa.concat_arrays(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([part], pa.int32()),
                 pa.array([held], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
                 pa.array([np.concatenate(lengths)], pa.list_(pa.int32())),
                 *(pa.array([x], pa.binary()) for x in group)],
                names=["shard", "part", "n_ids", "doc_ids", "lengths",
                       "ranks", "blocks", "words"])

        for own, cuts in _parted(pieces, slices(batches)):
            found, sizes = pieces.of_cuts(cuts, end_id)
            begin = 0
            while held + len(found) >= GROUP_IDS and begin < len(sizes):
                upto = np.cumsum(sizes[begin:])
                last = int(np.searchsorted(upto, GROUP_IDS - held))
                if last == len(upto):
                    break
                take = int(upto[last])
                coded.append(found[:take])
                lengths.append(sizes[begin:begin + last + 1])
                ids.append(own.slice(begin, last + 1))
                held += take
                yield record()
                part, held, ids, lengths = part + 1, 0, [], []
                found, begin = found[take:], begin + last + 1
            if begin < len(sizes):
                coded.append(found)
                lengths.append(sizes[begin:])
                ids.append(own.slice(begin))
                held += len(found)
            del found
        pieces.forget()
        pa.default_memory_pool().release_unused()
        if ids:
            yield record()

    ordered = (rows.repartitionByRange(int(shards), F.col("id").asc_nulls_first())
               .sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("text")))
    with freed_shuffles(spark):
        ordered.mapInArrow(encode, _record_type(id_type)).write.parquet(path)


def read_tokens(spark: SparkSession, path: str, id_type: str = "bigint",
                with_ids: bool = False) -> DataFrame:
    """Per document, from the files: id, ``start``, ``n_tokens``, ``ids_crc32``.

    ``start`` counts the ids of all documents before; ``with_ids`` adds the ids
    themselves. A damaged block fails the read.
    """
    records = spark.read.schema(_record_type(id_type)).parquet(path)
    before = Window.partitionBy("shard").orderBy("part")
    groups = records.select("shard", "part", "n_ids").withColumn(
        "in_shard", F.sum("n_ids").over(before) - F.col("n_ids"))
    shards = records.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    shards = shards.withColumn(  # a row for each shard
        "base", F.sum("n_ids").over(Window.orderBy("shard")) - F.col("n_ids"))
    starts = groups.join(shards.select("shard", "base"), "shard").select(
        "shard", "part", (F.col("base") + F.col("in_shard")).alias("base"))
    schema = f"shard int, part int, id {id_type}, offset long, n_tokens long, ids_crc32 long"
    schema += ", ids array<long>" * with_ids

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                group = range_coder.Group(*(row.column(x)[0].as_py()
                                            for x in ("ranks", "blocks", "words")))
                ids = range_coder.decode(group).astype("<u4", copy=False)
                del group
                lengths = np.asarray(row.column("lengths")[0].as_py(), np.int64)
                ends = np.cumsum(lengths)
                raw = memoryview(ids).cast("B")
                arrays = [pa.array([row.column("shard")[0].as_py()] * len(ends), pa.int32()),
                          pa.array([row.column("part")[0].as_py()] * len(ends), pa.int32()),
                          row.column("doc_ids")[0].values,
                          pa.array(ends - lengths), pa.array(lengths),
                          pa.array([zlib.crc32(raw[4 * (e - n):4 * e])
                                    for e, n in zip(ends, lengths, strict=True)], pa.int64())]
                names = ["shard", "part", "id", "offset", "n_tokens", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array(np.split(ids.astype(np.int64), ends[:-1]),
                                           pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    rows = records.drop("n_ids").mapInArrow(decode, schema).join(starts, ["shard", "part"])
    return rows.select("id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens",
                       "ids_crc32", *["ids"] * with_ids)
