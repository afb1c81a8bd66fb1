"""Token counts by the whole-token shortcut.

Most words of a text are one vocabulary string each. Which strings encode
alone as exactly one token is proved once, by the tokenizer itself, before any
text is read; a word made only of such strings needs no merges, just counting.
Everything else goes to the tokenizer, once for each distinct word a worker
meets. The count of a text is the sum over its words because the tokenizers
this applies to drop white space and never join across it; that is proved for
the given file before the shortcut is used, and where it doesn't hold every
text is encoded whole.

Cases: a null or empty text has 0 bytes and 0 tokens; null and repeated ids
pass through, one row out for each row in; other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Distinct words a worker remembers before it starts afresh.
REMEMBERED_WORDS = 500_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
# The parts of a lower-cased ASCII word, in the alternation order of the
# word-end tokenizers; anything else is left to the tokenizer.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_PART_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def open_tokenizer(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def drops_space(path: str) -> bool:
    """Whether the file's own settings make white space a border no token crosses.

    True for a splitter that keeps only runs without white space, after a
    normaliser that works within words, and no special string with a space.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    first = steps[0] if steps else {}
    normal = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    return (first.get("type") == "Split" and first.get("behavior") == "Removed"
            and first.get("invert") is True
            and first.get("pattern", {}).get("Regex") == _PART_PATTERN
            and normal == ["NFC", "Replace", "Lowercase"]
            and not any(_space(x["content"]) or x["lstrip"] or x["rstrip"]
                        for x in spec.get("added_tokens", [])))


def _space(text: str) -> bool:
    return bool(re.search(r"\s", text))


def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings of lower-case ASCII parts that encode alone as one token."""
    tokenizer = open_tokenizer(path)
    found = set()
    for entry in tokenizer.get_vocab(with_added_tokens=False):
        surface = entry.removesuffix("</w>")
        if surface.isascii() and _PARTS.fullmatch(surface):
            found.add(surface)
    surfaces = sorted(found)
    encoded = tokenizer.encode_batch(surfaces, add_special_tokens=False)
    return frozenset(s for s, e in zip(surfaces, encoded, strict=True) if len(e.ids) == 1)


class _Counts(dict):
    """Tokens of a word, worked out at first sight."""

    def __init__(self, tokenizer: Tokenizer, single: frozenset[str]) -> None:
        super().__init__()
        self.tokenizer, self.single = tokenizer, single
        self.parts: dict[str, int] = dict.fromkeys(single, 1)

    def _encoded(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, word: str) -> int:
        if word in self.single:
            n = 1
        elif word.isascii() and word.isprintable() and "<|" not in word:
            n = 0
            for part in _PARTS.findall(word.lower()):
                if part not in self.parts:
                    if len(self.parts) >= REMEMBERED_WORDS:
                        self.parts = dict.fromkeys(self.single, 1)
                    self.parts[part] = self._encoded(part)
                n += self.parts[part]
        else:
            n = self._encoded(word)
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        self[word] = n
        return n


_open: dict[str, object] = {}


def _counter(path: str, single: frozenset[str] | None):
    """One per worker and file; a reused worker keeps what it has learnt."""
    if path not in _open:
        tokenizer = open_tokenizer(path)
        if single is None:
            _open[path] = lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)
        else:
            known = _Counts(tokenizer, single)
            _open[path] = lambda text: sum(map(known.__getitem__, _WORD.findall(text)))
    return _open[path]


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_bytes`` and ``n_tokens``, as the tokenizers library counts them.

    ``tokenizer_path`` must open on every executor. The proof travels as one
    broadcast set, bounded by the vocabulary.
    """
    spark = docs.sparkSession
    single = whole_tokens(tokenizer_path) if drops_space(tokenizer_path) else None
    proof = spark.sparkContext.broadcast(single)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_of = _counter(tokenizer_path, proof.value)
        for batch in batches:
            texts = batch.column("text")
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"),
                 pa.array([tokens_of(t) if t else 0 for t in texts.to_pylist()], pa.int64())],
                names=["id", "n_bytes", "n_tokens"])

    return (rows.select("id", "text", F.coalesce(F.octet_length("text"), F.lit(0))
                        .cast("long").alias("n_bytes"))
            .mapInArrow(count, f"id {id_type}, n_bytes long, n_tokens long")
            .withColumnRenamed("id", id_col))
