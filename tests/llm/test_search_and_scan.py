"""Top-k search, licence scan and decontamination."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from pyspark.sql import functions as F

from tests.llm.cases import awkward, documents, lowered, prose
from tests.oracle import compare, connect
from tidemark.llm import decontaminate, licenses, queries, topk_search


def plain_top(rows, k, is_query):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(
                x is not None and math.isfinite(x) for x in v):
            good.setdefault((i, tuple(math.floor(1024 * float(x)) for x in v)), None)
    out = []
    by_id = {}
    for i, v in good:
        by_id.setdefault(i, []).append(v)
    for i, vectors in by_id.items():
        if not is_query(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, c)), j)
                        for q in vectors for j, c in good if j != i)[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def got_top(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_top_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25, 1.0]), (1, [0.5, -0.25, 1.0]), (2, [0.5, -0.25]), (3, None),
            (4, [nan, 1.0, 1.0]), (5, [None, 1.0, 0.0]), (6, [inf, 0.0, 0.0]), (7, []),
            (None, [1.0, 1.0, 1.0]), (100, [-1.0, 0.001, 0.0]), (100, [-1.0, 0.001, 0.0]),
            (8, [0.0, 0.0, 0.0])]
    got = got_top(topk_search.top_k(vectors(spark, rows), F.col("vec_id") % 100 == 0, k=3))
    assert got == plain_top(rows, 3, lambda i: i % 100 == 0)


@pytest.mark.parametrize("shard_rows,block", [(16_384, 2_048), (40, 3)])
def test_top_over_shards_and_blocks(spark, monkeypatch, shard_rows, block):
    monkeypatch.setattr(topk_search, "_STRIDE", 16)
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in rng.normal(size=6) * (rng.random(6) < 0.5)])
            for i in rng.permutation(500)]
    rows += [(1000 + k, rows[0][1]) for k in range(100)]  # one vector very often
    found = topk_search.top_k(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=5,
                              shard_rows=shard_rows, query_block=block)
    assert got_top(found) == plain_top(rows, 5, lambda i: i % 20 == 0)


def test_top_prunes_lists():
    """With a high floor most terms are non-essential, and few candidates are probed."""
    rng = np.random.default_rng(1)
    weights = rng.integers(-5, 6, (3000, 12))
    weights[:10, 0] = 1000
    postings = topk_search._Postings(np.arange(3000), weights)
    query = np.array([50] + [1] * 11)
    first = postings.best(-1, query, 10, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    want = np.sort(weights @ query)[::-1][:10]
    assert first[0].tolist() == want.tolist()
    others = topk_search._Postings(np.arange(5000, 8000), np.where(weights > 5, 5, weights))
    assert others.best(-1, query, 10, first)[1].tolist() == first[1].tolist()


def test_top_empty(spark):
    assert topk_search.top_k(vectors(spark, []), F.col("vec_id") % 100 == 0).count() == 0


def plain_leaks(rows, items, size=10):
    def words(text):
        return decontaminate.words_of((text or "").encode())
    windows = {}
    for item, text in items:
        own = words(text)
        for k in range(max(1, len(own) - size + 1) if own else 0):
            windows.setdefault(tuple(own[k:k + size]), set()).add(
                "" if item is None else str(item))
    out = []
    for doc, text in rows:
        own = words(text)
        hit, names = set(), set()
        for length in {len(w) for w in windows}:
            for k in range(len(own) - length + 1):
                part = tuple(own[k:k + length])
                if part in windows:
                    hit.update(range(k, k + length))
                    names |= windows[part]
        out.append((doc, len(own), len(hit), sorted(names)))
    return sorted(out, key=repr)


ITEMS = [(1, prose(1, 120)[:200]), (1, "w1 w2"), (2, "one"), (3, "A b, C d!"), (4, None), (5, ""),
         (6, "!!"), (None, "漢字"), (7, prose(2, 25)), (8, "ab " * 30), (8, "ab " * 30)]


def got_leaks(df):
    return sorted(((r["row"].doc_id, r.n_words, r.n_hit, r["items"]) for r in df.collect()),
                  key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_leaks_awkward(spark, block_bytes):
    rows = awkward() + [(50, "ab " * 40), (51, "x " + prose(2, 25) + " y"), (52, "C d a b c D")]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.find_leaks(documents(spark, rows), items, keep=["doc_id"],
                                     block_bytes=block_bytes)
    assert got_leaks(found) == plain_leaks(rows, ITEMS)


def test_leaks_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    found = decontaminate.find_leaks(documents(spark, awkward()), items, keep=["doc_id"])
    assert {r.n_hit for r in found.collect()} == {0}
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.find_leaks(documents(spark, []), items, keep=["doc_id"]).count() == 0


def test_words_are_the_contract_pattern():
    import re
    text = "Ab_c d-e\x00f É9 漢字~ [x] {y}\x7fZ"
    want = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    assert [w.decode() for w in decontaminate.words_of(text.encode())] == want


def test_prefix_is_the_rarest_shingle():
    window = (b"the", b"of", b"rare", b"the")
    often = {(b"the", b"of"): 90, (b"of", b"rare"): 1, (b"rare", b"the"): 2}
    index = decontaminate.WindowIndex({window: ["1"]}, often)
    assert list(index.by_shingle) == [(b"of", b"rare")]
    assert list(index.find([b"x", *window])) == [(1, 5, ["1"])]
    assert list(index.find([b"of", b"rare", b"the"])) == []


LICENSE_ROWS = [
    (1, "Licensed under the Apache License, Version 2.0.", "en", "a"),
    (12, "plain text without any notice. " * 20, "en", "a"),
    (123, "Some text. This work is licensed under the GNU General Public License, version 3. More "
          "words follow here and there.", "en", "a"),
    (1234, "nothing", "en", "a"), (2, None, None, None), (2, "", None, None),
    (3, "Released under the MIT License", "en", None), (31, "x", "en", None),
    (31, "x", "en", None), (None, "All rights reserved.", "en", "a"),
    (4, "license license license version general public " * 50, "en", "a"),
    (5, prose(1, 20_000) + "\nLicensed under CC BY-NC 4.0.\n", "en", "a")]


def test_licenses_awkward_against_sql(spark, tmp_path):
    docs = documents(spark, LICENSE_ROWS)
    found = licenses.scan(docs, queries.document_path(), keep=["doc_id"])
    pq.write_table(docs.toArrow(), tmp_path / "documents.parquet")
    sql = queries.license_sql(licenses.TEMPLATES, licenses.SIMILARITY, licenses.FILE_SHARE)
    assert compare(found, connect(str(tmp_path)), sql) is None
    of = {(r.doc_id, r.license, r.inherited_from) for r in found.collect()}
    assert (1, "Apache-2.0", None) in of and (12, "Apache-2.0", "/a/en") in of
    # more than half of 123 is its notice, so it speaks for /a/en/1/2 and below
    assert (123, "GPL-3.0", None) in of and (1234, "GPL-3.0", "/a/en/1/2") in of
    assert (31, "MIT", "/_/en") in of and (5, "CC-BY-NC-4.0", None) in of


def test_licenses_nearest_directory_wins(spark):
    rows = [("/p/LICENSE", "Released under the MIT License"),
            ("/p/q/LICENSE", "Licensed under the Apache License, Version 2.0"),
            ("/p/q/r/file", "text"), ("/p/s/file", "text"), ("/o/file", "text"), (None, "text")]
    files = spark.createDataFrame(rows, "path string, text string")
    found = licenses.scan(files.withColumnRenamed("path", "where"), F.col("where"),
                          keep=["where"])
    assert {r["where"]: r.license for r in found.collect()} == {
        "/p/LICENSE": "MIT", "/p/q/LICENSE": "Apache-2.0", "/p/q/r/file": "Apache-2.0",
        "/p/s/file": "MIT", "/o/file": None, None: None}


def test_licenses_must_haves_are_enough():
    idf = {w: 1.0 for _, t in licenses.TEMPLATES for w in licenses._words(t)}
    idf |= {"the": 0.1, "of": 0.1}
    known = licenses.vectors(licenses.TEMPLATES, idf)
    needed = set(licenses.must_haves(known, 0.75))
    for v in known:
        rest = math.sqrt(sum(x * x for w, x in v.weights.items() if w not in needed))
        assert rest < 0.75
    assert "the" not in needed


def test_licenses_empty_and_native(spark):
    found = licenses.scan(documents(spark, []), queries.document_path(), keep=["doc_id"])
    assert found.count() == 0
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def scanned(spark, rows):
    files = spark.createDataFrame(rows, "where string, text string")
    return {r["where"]: r for r in
            licenses.scan(files, F.col("where"), keep=["where"]).collect()}


def test_licenses_whole_texts_are_licence_files(spark):
    texts = dict(licenses.TEXTS)
    wrapped = texts["MIT"]
    by_paragraph = "\n".join(" ".join(p.split()) for p in wrapped.split("\n\n"))
    bsd = texts["BSD-3-Clause"].replace("\n", "\r\n") + "\r\nAll rights reserved."
    rows = [("/m/LICENSE", wrapped), ("/m/src/a", "int main"), ("/p/LICENSE", by_paragraph),
            ("/p/b", "int b"), ("/b/COPYING", bsd), ("/b/c", "int c"), ("/o/d", "int d"),
            ("/e/prose", prose(1, 20_000)), ("/n/none", None)]
    rows += [(f"/{name}/LICENSE", text) for name, text in texts.items()]
    rows += [(f"/filler/{k}", prose(100 + k, 50)) for k in range(40)]
    found = scanned(spark, rows)
    for where, name in (("/m/LICENSE", "MIT"), ("/p/LICENSE", "MIT"),
                        ("/b/COPYING", "BSD-3-Clause"),
                        *((f"/{n}/LICENSE", n) for n in texts)):
        assert (found[where].own_license, found[where].license_file) == (name, True), where
        assert found[where].similarity > 0.9
    assert [found[w].license for w in ("/m/src/a", "/p/b", "/b/c", "/o/d", "/n/none")] == [
        "MIT", "MIT", "BSD-3-Clause", None, None]
    assert found["/m/src/a"].inherited_from == "/m" and found["/e/prose"].license is None


def test_licenses_wrapped_headers(spark):
    code = "\n".join(f"int f{k}(void) {{ return g{k}; }}" for k in range(30))
    bsd = ("/* Copyright (c) 2020 A. Nobody\n *\n * Redistribution and use in source and binary "
           "forms, with or without\n * modification, are permitted provided that the following "
           "conditions\n * are met:\n *\n */\n\n")
    apache = "".join(f"# {x}\n" for x in dict(licenses.HEADERS)["Apache-2.0"].splitlines())
    lesser = "".join(f"// {x}\n" for x in dict(licenses.HEADERS)["LGPL-3.0"].splitlines())
    sentence = ("# Some tool. This work is licensed under the GNU\n"
                "# General Public License, version 3. Much else\n# is told in the same block.\n")
    rows = [("/a", bsd + code), ("/b", apache + "\n" + code), ("/c", lesser + "\n" + code),
            ("/d", sentence + "\n" + code), ("/e", code), ("/f", bsd), ("/f", bsd)]
    found = scanned(spark, rows)
    assert [(found[w].own_license, found[w].license_file) for w in ("/a", "/b", "/c", "/d", "/e")] \
        == [("BSD-3-Clause", False), ("Apache-2.0", False), ("LGPL-3.0", False),
            ("GPL-3.0", False), (None, False)]


def test_licenses_rare_words_are_needed():
    idf = {w: 1.0 + len(w) for _, t in licenses.TEXTS for w in licenses._words(t)}
    for v in licenses.vectors(licenses.TEXTS, idf):
        rare, least = licenses.rare_words(v, idf, 0.75)
        common = sum(x * x for w, x in v.weights.items() if w not in rare)
        heaviest = sorted((v.weights[w] for w in rare), reverse=True)[:least - 1]
        assert least >= 1 and common + sum(x * x for x in heaviest) < 0.75 ** 2
