"""Small tables with the rows that break things, and plain versions of the operators."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# extra columns whose names the operators use inside
CLASHING = {"id": "string", "key": "int", "row": "string", "text_": "string", "n": "int",
            "score": "double", "size": "long", "copies": "long", "packed": "binary",
            "members": "string", "component_id": "long"}


def documents(spark, rows, clash=True):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    extra = ", ".join(f"{c} {t}" for c, t in CLASHING.items()) if clash else ""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    full = []
    for row in rows:
        doc, text, lang, source = (*row, "en", "s")[:4] if len(row) == 2 else row
        full.append((doc, text, lang, source, len(text or ""),
                     *([None] * (len(CLASHING) if clash else 0))))
    return spark.createDataFrame(full, f"{schema}, {extra}" if extra else schema)


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    out = []
    for k in range(words):
        word = f"w{rng.randrange(vocabulary)}" + rng.choice(["", "", "", ".", ",", "é"])
        out.append(word.capitalize() if rng.random() < 0.1 else word)
        out.append("\n" if rng.random() < 0.05 else " ")
    return "".join(out)


def awkward():
    """Nulls, empty and very long texts, copies, near copies, ties and repeated rows."""
    base = prose(1, 120)
    words = base.split(" ")
    near = " ".join(words[:60] + ["changed"] + words[61:])
    rows = [(5, base), (3, base), (9, near), (9, near), (None, base), (None, None), (7, None),
            (8, ""), (11, " \n\t"), (12, "one two"), (13, "One  two"), (14, "a b c d e f"),
            (15, "a b c d e g"), (16, prose(2, 30_000)), (17, prose(3, 200) + base),
            (18, "ab" * 400), (19, "ab" * 400 + "c"), (20, "\x00\x1f x é ß ǅ 漢字 🙂"),
            (21, prose(4, 11)), (22, prose(4, 11) + " end"), (-4, prose(5, 60)), (0, prose(5, 60))]
    return rows


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def grouped(rows, keys=("doc_id",)):
    """Rows as a sorted list of plain tuples."""
    return sorted((tuple(r) for r in rows), key=repr)
