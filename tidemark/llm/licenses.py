"""Licence scans: TF-IDF cosine to templates, then inheritance along directories.

Every text is cut into lines and sentences, and each of these is compared with
every template as a sparse TF-IDF vector. Document frequencies are counted over
all files for the words of the templates; any other word weighs like one that
no file has, so it only lengthens the vector it is in. Words a template can't
do without for the required cosine are worked out from their weights, and only
lines that hold such a word are compared.

Lines are not all: whole files, their blocks (neighbouring lines, up to one
without a word) and the sentences of a block that go over a line's end are
compared as one vector each with the full texts of licences, with the headers
they ask for and with the notices above. Only files and blocks that hold enough
of a template's rarer words for the required cosine are looked at.

A file takes the licence whose full text it is like, else that of its best
line, unless it, a block or a sentence is more like a template. A file that consists of
licence lines for the most part, or is like a template as a whole, is a licence
file and speaks for its directory; files
without a licence of their own inherit from the nearest directory above that
has one. Directories are joined by path: distinct directories first, their
ancestors after, files last.

All of it are DataFrame expressions. Only template words, their frequencies
and the templates themselves are literals, bounded by the templates. The words
of whole files and blocks are counted by grouping, once for equal texts.

Cases: a null or empty text has no licence and may inherit one; a null path is
the root's file ""; equal paths are separate files; between equal cosines the
earlier line, then the template that sorts first, wins; between licence files
of a directory the higher cosine, then the licence that sorts first.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from pathlib import Path
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged

# Notices by which works state their licence, as the licences word them.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 "
                  "International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial "
                     "4.0 International License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under "
                "the terms of the GNU General Public License"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
            "this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "v. 2.0"),
    ("Proprietary", "All rights reserved"),
]

#: Full texts of licences; compared with files and blocks.
TEXTS: list[tuple[str, str]] = [
    (p.stem, p.read_text("utf-8")) for p in sorted((Path(__file__).parent / "texts").glob("*.txt"))]

#: Headers that licences ask for; compared with files and blocks.
HEADERS: list[tuple[str, str]] = [
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""),
    ("LGPL-3.0", """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Lesser General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
]

#: Least cosine of a line, a block or a file to a template.
SIMILARITY = 0.75
#: Share of a file's words in licence lines that makes it a licence file.
FILE_SHARE = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


class _Vector(NamedTuple):
    name: str
    weights: dict[str, float]   # of unit length


def vectors(templates: list[tuple[str, str]], idf: dict[str, float]) -> list[_Vector]:
    found = []
    for name, text in templates:
        raw = {w: n * idf[w] for w, n in sorted(Counter(_words(text)).items())}
        length = math.sqrt(sum(x * x for x in raw.values()))
        found.append(_Vector(name, {w: x / length for w, x in raw.items()}))
    return found


def must_haves(templates: list[_Vector], similarity: float) -> list[str]:
    """Words of which a line needs at least one to come near any template.

    The cosine is at most the length of the template's part that is shared, so
    a template's light words may be ignored as long as together they are
    shorter than the similarity asked for.
    """
    needed = set()
    for vector in templates:
        left = 0.0
        for word, weight in sorted(vector.weights.items(), key=lambda x: (x[1], x[0])):
            left += weight * weight
            if math.sqrt(left) >= similarity:
                needed.add(word)
    return sorted(needed)


def _strings(words: list[str]) -> Column:
    return F.array(*(F.lit(w) for w in words))


def _folded(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)


def _lines(text: Column) -> Column:
    """Words of each line or sentence."""
    parted = F.regexp_replace(_folded(text), r"([.!?;])[ \t\r\n\f]+", "$1\n")
    return F.transform(F.split(parted, r"[\r\n]+"), _tokens)


def _blocks(text: Column) -> Column:
    """Lines joined by line breaks, up to the next line without a word."""
    lines = F.split(_folded(text), "\r\n|\n|\r")
    lines = F.transform(lines, lambda x: F.when(x.rlike("[a-z0-9]"), x).otherwise(F.lit("")))
    return F.split(F.array_join(lines, "\n"), "\n\n+")


def _wrapped(block: Column) -> Column:
    """Sentences of a block that go over a line's end."""
    parts = F.split(F.regexp_replace(block, r"([.!?;])[ \t\n\f]+", "$1\r"), "\r")
    return F.filter(parts, lambda x: x.contains("\n"))


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("[a-z0-9]+"), F.lit(0))


def inverse_frequencies(files: DataFrame, text_col: str,
                        templates: list[tuple[str, str]]) -> tuple[dict[str, float], float]:
    """Of each template word over all files, and of a word that no file has."""
    vocabulary = sorted({w for _, text in templates for w in _words(text)})
    own = F.array_intersect(_tokens(_folded(F.col(text_col))), _listed(vocabulary))
    rows = (files.select(F.explode(F.concat(F.array(F.lit("")), own)).alias("word"))
            .groupBy("word").count().collect())
    held = {r.word: r["count"] for r in rows}
    n = held.get("", 0)  # every file counts once with the empty word
    return ({w: math.log((1 + n) / (1 + held.get(w, 0))) + 1 for w in vocabulary},
            math.log(1 + n) + 1)


def _listed(words: list[str]) -> Column:
    return F.split(F.lit(" ".join(words)), " ")


class Texts:
    """Templates that files and blocks are compared with as a whole."""

    def __init__(self, templates: list[tuple[str, str]], idf: dict[str, float], unseen: float,
                 similarity: float, full: list[tuple[str, str]]):
        self.known = vectors(templates, idf)
        self.full = [k for k, template in enumerate(templates) if template in full]
        self.idf, self.unseen, self.similarity = idf, unseen, similarity
        self.vocabulary = sorted(idf)
        self.rare = [rare_words(v, idf, similarity) for v in self.known]

    def near(self, words: Column) -> Column:
        """Whether ``words`` hold enough different rare words of any template."""
        def enough(own: Column) -> Column:
            one = F.lit(False)
            for rare, least in self.rare:
                one = one | (F.size(F.array_intersect(own, _listed(rare))) >= least)
            return (F.size(own) >= min((n for _, n in self.rare), default=0)) & one
        # bound once by the lambda, not worked out for each template
        own = F.array(F.array_intersect(words, _listed(
            sorted({w for rare, _ in self.rare for w in rare}))))
        return F.exists(own, enough)

    def units(self, lines: Column, text: Column) -> Column:
        """Structs (whole, words) to compare: the file, its blocks and sentences over lines."""
        def unit(whole: bool):
            return lambda x: F.struct(F.lit(whole).alias("whole"), x.alias("words"))
        words = F.flatten(lines)
        wrapped = F.flatten(F.transform(_blocks(text), _wrapped))
        parts = F.transform(F.concat(_blocks(text), wrapped), _tokens)
        whole = F.transform(F.array(words), unit(True))
        both = F.concat(whole, F.transform(F.filter(parts, self.near), unit(False)))
        return F.when(self.near(words), both)

    def matches(self, found: DataFrame) -> DataFrame:
        """Of rows (key, units) ``key``, the full text ``file`` is like and the best ``part``."""
        spark = found.sparkSession
        rows = [{"word": w, "idf": self.idf[w],
                 "held": [{"k": k, "x": v.weights[w]} for k, v in enumerate(self.known)
                          if w in v.weights]} for w in self.vocabulary]
        kind = "array<struct<word:string,idf:double,held:array<struct<k:int,x:double>>>>"
        weights = F.broadcast(spark.range(1).select(F.inline(F.from_json(
            F.lit(json.dumps(rows)), kind))))
        names = F.array(*(F.lit(v.name) for v in self.known))
        unit = ["key", "unit", "whole"]
        counted = staged(
            found.dropDuplicates(["key"])
            .select("key", F.posexplode("units").alias("unit", "of"))
            .select("key", "unit", "of.whole", F.explode("of.words").alias("word"))
            .groupBy(*unit, "word").agg(F.count("*").alias("n"))
            .join(weights, "word", "left")
            .select(*unit, (F.col("n") * F.coalesce("idf", F.lit(self.unseen))).alias("x"),
                    "held"), "units")
        lengths = counted.groupBy(*unit).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"))
        dots = (counted.select(*unit, F.col("x").alias("own"), F.inline("held"))
                .groupBy(*unit, "k").agg(F.sum(F.col("own") * F.col("x")).alias("dot")))
        scored = (dots.join(lengths, unit)
                  .select("key", "whole", (-F.round(F.col("dot") / F.col("length"), 6)).alias("s"),
                          "unit", "k").where(F.col("s") <= -self.similarity))
        first = F.struct("s", "unit", "k")
        full = F.col("whole") & F.col("k").isin(self.full)
        best = scored.groupBy("key").agg(F.min(F.when(full, first)).alias("file"),
                                         F.min(first).alias("part"),
                                         F.max("whole").alias("like"))
        return best.select("key", *(
            F.when(F.col(c).isNotNull(), F.struct(
                (-F.col(f"{c}.s")).alias("similarity"),
                F.element_at(names, F.col(f"{c}.k") + 1).alias("name"))).alias(c)
            for c in ("file", "part")), "like")


def rare_words(vector: _Vector, idf: dict[str, float], similarity: float) -> tuple[list[str], int]:
    """A template's rarer words, and how many of them a text needs at least for the cosine.

    The cosine is at most the length of the template's part that is shared, so
    the commonest words, which hold up to half of what the square asks for,
    leave the rest to the others; the heaviest of these reach it soonest.
    """
    asked, common = similarity * similarity, 0.0
    words = sorted(vector.weights, key=lambda w: (idf[w], w))
    while words and common + vector.weights[words[0]] ** 2 <= asked / 2:
        common += vector.weights[words.pop(0)] ** 2
    held = 0.0
    for n, weight in enumerate(sorted((vector.weights[w] for w in words), reverse=True), 1):
        held += weight * weight
        if held >= asked - common - 1e-6:
            return sorted(words), n
    return sorted(words), len(words)


def best_notice(lines: Column, templates: list[_Vector], idf: dict[str, float],
                unseen: float) -> Column:
    """Per line of ``lines`` the struct (similarity, name) of its nearest template."""
    weight_of = F.create_map(*(x for w, v in sorted(idf.items()) for x in (F.lit(w), F.lit(v))))

    def times(line: Column, word: Column) -> Column:
        return F.size(F.filter(line, lambda x: x == word)).cast("double")

    def nearest(line: Column) -> Column:
        weights = F.transform(
            F.array_distinct(line),
            lambda w: times(line, w) * F.coalesce(F.element_at(weight_of, w), F.lit(unseen)))
        length = F.sqrt(F.aggregate(weights, F.lit(0.0), lambda s, x: s + x * x))
        found = []
        for vector in templates:
            shared = F.lit(0.0)
            for word, weight in vector.weights.items():
                shared = shared + times(line, F.lit(word)) * F.lit(idf[word] * weight)
            found.append(F.struct(F.round(shared / length, 6).alias("similarity"),
                                  F.lit(vector.name).alias("name")))
        return F.reduce(F.array(*found), found[0],
                        lambda a, b: F.when(b["similarity"] > a["similarity"], b).otherwise(a))
    return F.transform(lines, nearest)


def scan(files: DataFrame, path: Column, keep: list[str], text_col: str = "text",
         templates: list[tuple[str, str]] = TEMPLATES, similarity: float = SIMILARITY,
         file_share: float = FILE_SHARE, texts: list[tuple[str, str]] = TEXTS,
         headers: list[tuple[str, str]] = HEADERS) -> DataFrame:
    """Columns ``keep``, ``path``, ``own_license``, ``similarity``, ``license_file``,
    ``license`` and ``inherited_from`` (the directory, where it is inherited) of each file."""
    templates, every = sorted(templates), sorted({*templates, *headers, *texts})
    all_idf, unseen = inverse_frequencies(files, text_col, every)
    full = Texts(every, all_idf, unseen, similarity, texts)
    idf = {w: all_idf[w] for w in sorted({w for _, text in templates for w in _words(text)})}
    known = vectors(templates, idf)
    needed = _strings(must_haves(known, similarity))
    row = F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row")
    read = files.select(row, F.coalesce(path, F.lit("")).alias("path"),
                        F.col(text_col).alias("text"), _lines(F.col(text_col)).alias("all"))
    words = F.aggregate("all", F.lit(0), lambda s, x: s + F.size(x))
    read = read.select("row", "path", "text", "all", words.alias("words"),
                       F.filter("all", lambda x: F.arrays_overlap(x, needed)).alias("lines"))
    met = read.withColumn("notices", best_notice(F.col("lines"), known, idf, unseen))
    met = met.withColumn("notices", F.filter(
        F.zip_with("notices", "lines", lambda n, x: F.struct(
            n["similarity"].alias("similarity"), n["name"].alias("name"),
            F.size(x).alias("words"))), lambda n: n["similarity"] >= similarity))
    best = F.reduce("notices", F.element_at(F.col("notices"), 1), lambda a, b: F.when(
        b["similarity"] > a["similarity"], b).otherwise(a))
    said = F.aggregate("notices", F.lit(0), lambda s, n: s + n["words"])
    units = full.units(F.col("all"), F.col("text"))
    by_line = staged(
        met.withColumn("best", F.when(F.size("notices") > 0, best)).withColumn("units", units)
        .select("row", "path", _parent(F.col("path")).alias("dir"),
                F.struct("best.similarity", "best.name").alias("line"),
                (F.col("best").isNotNull() & (said >= F.col("words") * file_share))
                .alias("mostly"),
                F.when(F.col("units").isNotNull(), F.sha2(F.col("text").cast("binary"), 256))
                .alias("key"), "units"), "licenses")
    matches = staged(full.matches(by_line.where(F.col("key").isNotNull()).select("key", "units")),
                     "matches")
    by_line = by_line.drop("units")
    none = F.lit(None).cast(matches.schema["file"].dataType)
    own = (by_line.where(F.col("key").isNotNull()).join(matches, "key", "left").drop("key")
           .unionByName(by_line.where(F.col("key").isNull()).drop("key")
                        .withColumns({"file": none, "part": none,
                                      "like": F.lit(None).cast("boolean")})))
    line = F.when(F.col("line.name").isNotNull(), F.col("line"))
    more = (F.col("part").isNotNull()
            & (line.isNull() | (F.col("part.similarity") > F.col("line.similarity"))))
    own = (own.withColumn("more", F.coalesce(more, F.lit(False)))
           .withColumn("own", F.coalesce("file", F.when(F.col("more"), F.col("part")), line))
           .select("row", "path", "dir", F.col("own.name").alias("own_license"),
                   F.col("own.similarity"),
                   (F.col("mostly") | F.col("file").isNotNull()
                    | (F.col("more") & F.coalesce("like", F.lit(False)))).alias("license_file")))

    best_first = F.struct(-F.col("similarity"), F.col("own_license"))
    of_dir = own.where("license_file").groupBy("dir").agg(F.min(best_first).alias("best")).select(
        F.col("dir").alias("above"), F.col("best.own_license").alias("held"))
    dirs = own.where(F.col("own_license").isNull()).select("dir").distinct()
    nearest = (dirs.withColumn("above", F.explode(_upwards(F.col("dir")))).join(of_dir, "above")
               .groupBy("dir").agg(F.max(F.struct(F.length("above"), "above", "held"))
                                   .alias("near"))
               .select("dir", F.col("near.above").alias("from_dir"),
                       F.col("near.held").alias("held")))
    bare = F.col("own_license").isNull()
    return own.join(nearest, "dir", "left").select(
        "row.*", "path", "own_license", "similarity", "license_file",
        F.coalesce("own_license", "held").alias("license"),
        F.when(bare, F.col("from_dir")).alias("inherited_from"))


def _parent(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def _upwards(directory: Column) -> Column:
    """The directory and all above it, down to the root ""."""
    parts = F.split(directory, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
