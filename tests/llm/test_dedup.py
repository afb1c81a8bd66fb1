"""Suffix dedup, sentence spans and the Jaccard join against plain versions."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.cases import WORD, awkward, documents, lowered, prose
from tidemark.llm import components, jaccard_join, occurrences, queries, span_dedup, suffix_dedup
from tidemark.plans.registry import table


def plain_suffix(rows, window):
    """Removed bytes by definition: every window's earliest place over all rows."""
    rows = [(-(1 << 63) if d is None else d, (t or "").encode()) for d, t in rows]
    first = {}
    for doc, text in rows:
        for at in range(len(text) - window + 1):
            part = text[at:at + window]
            first[part] = min(first.get(part, (doc, at)), (doc, at))
    out = []
    for doc, text in rows:
        gone = bytearray(len(text))
        for at in range(len(text) - window + 1):
            if first[text[at:at + window]] < (doc, at):
                gone[at:at + window] = b"\1" * window
        runs = sum(1 for k in range(len(text)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(c for c, g in zip(text, gone) if not g)
        out.append((doc, len(text), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got_suffix(df):
    return sorted((-(1 << 63) if r.doc_id is None else r.doc_id, r.n_bytes,
                   r.n_bytes - len(r.kept), len(r.spans) // 2,
                   hashlib.sha256(bytes(r.kept)).hexdigest()) for r in df.collect())


def test_suffix_awkward(spark):
    rows = awkward()
    got = got_suffix(suffix_dedup.remove_repeats(documents(spark, rows)))
    assert got == plain_suffix(rows, 100)


def test_suffix_small_window_many_overlaps(spark):
    rng = random.Random(7)
    rows = [(k, "".join(rng.choice("ab") for _ in range(rng.randrange(0, 90))))
            for k in rng.sample(range(1000), 60)]
    got = got_suffix(suffix_dedup.remove_repeats(documents(spark, rows), window=12, gram=5))
    assert got == plain_suffix(rows, 12)


def test_suffix_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    rows = [(1, prose(1, 900)), (2, prose(2, 50) + prose(1, 900)[1500:4200]), (3, "z" * 5000)]
    rows_of = suffix_dedup._runs(100, 32)
    batch = documents(spark, rows).selectExpr("doc_id id", "crc32(text) check",
                                              "cast(text as binary) text").toArrow()
    runs = [r for b in batch.to_batches() for r in rows_of(b)]
    starts = sum(int(r["run"].sum()) for r in runs)
    assert starts == sum(len(t.encode()) - 99 for _, t in rows)
    assert got_suffix(suffix_dedup.remove_repeats(documents(spark, rows))) == \
        plain_suffix(rows, 100)


def test_suffix_empty_table_and_bounds(spark):
    empty = documents(spark, [])
    assert suffix_dedup.remove_repeats(empty).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(empty, window=400, gram=32)


def test_suffix_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                 for r in queries.op4_suffix_dedup(spark, sf_dir).collect())
    assert got == plain_suffix(rows, 100)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=80), st.integers(1, 9))
def test_least_is_leftmost_minimum(values, width):
    values = np.array(values, np.uint64)
    if len(values) < width:
        return
    got = suffix_dedup._least(values, width)
    assert got.tolist() == [at + int(np.argmin(values[at:at + width]))
                            for at in range(len(values) - width + 1)]


def test_hot_string_reaches_its_bucket_once_for_each_batch():
    n = 5000
    rows = {"k1": np.full(n, 7, np.uint64), "k2": np.full(n, 9, np.uint64),
            "id": np.arange(n), "check": np.zeros(n, np.uint32),
            "at": np.zeros(n, np.uint32), "run": np.ones(n, np.uint8)}
    packed = occurrences.pack(rows, 16)
    sent = [r for r in packed.to_pylist() if r["kind"] == 0]
    assert len(sent) == 1 and len(sent[0]["data"]) == occurrences._ROW
    assert len(packed.to_pylist()) == n  # the others are settled


def common_gram(n, batch):
    """Rows of ``n`` documents with one gram in different surroundings, and one of their own."""
    rng = np.random.default_rng(n)
    ids = np.repeat(np.arange(n), 2)
    k1 = rng.integers(1 << 60, size=2 * n, dtype=np.uint64)
    k1[::2] = 7
    rows = {"k1": k1, "k2": rng.integers(1 << 63, size=2 * n, dtype=np.uint64), "id": ids,
            "check": np.zeros(2 * n, np.uint32), "at": np.zeros(2 * n, np.uint32),
            "run": np.ones(2 * n, np.uint8)}
    return [{name: column[a:a + batch] for name, column in rows.items()}
            for a in range(0, 2 * n, batch)]


def test_common_gram_in_different_surroundings_does_not_gather():
    """Each batch sends two rows of it, and knows the others to be open."""
    largest = {}
    for n in (2000, 20_000):
        sizes, opened = Counter(), 0
        for rows in common_gram(n, 2000):
            for r in occurrences.pack(rows, 64, refine=True).to_pylist():
                if r["kind"] == occurrences._OCCURRENCES:
                    sizes[r["bucket"]] += len(r["data"]) // occurrences._ROW
                else:
                    assert r["kind"] == occurrences.OPEN
                    opened += len(occurrences.unpacked([r["data"]]))
        assert sum(sizes.values()) + opened == 2 * n and opened > 0.9 * n
        largest[n] = max(sizes.values()) / n
    assert largest[20_000] <= 1.1 * largest[2000] and largest[20_000] < 3 / 64


def test_buckets_are_even(spark):
    """Runs are named by least hashes, which crowd near zero; their buckets don't."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    batch = docs.selectExpr("doc_id id", "crc32(text) check", "cast(text as binary) text")
    sizes = Counter()
    for rows in suffix_dedup._runs(100, 32)(batch.toArrow().combine_chunks().to_batches()[0]):
        rows = {name: column.astype(kind) for (name, kind), column in
                zip(occurrences._KINDS, (rows[k] for k, _ in occurrences._KINDS))}
        for r in occurrences.pack(rows, 64, refine=True).to_pylist():
            if r["kind"] == occurrences._OCCURRENCES:
                sizes[r["bucket"]] += len(r["data"])
    assert max(sizes.values()) < 3 * sum(sizes.values()) / 64


def test_suffix_common_passage_in_different_surroundings(spark):
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(90))
    rows = [(k, "".join(rng.choice("ij kl") for _ in range(rng.randrange(150))) + passage
             + "".join(rng.choice("mno") for _ in range(rng.randrange(3, 120)))) for k in range(60)]
    rows += [(100 + k, rows[k][1][10:]) for k in range(20)]
    got = got_suffix(suffix_dedup.remove_repeats(documents(spark, rows)))
    assert got == plain_suffix(rows, 100)


def plain_spans(rows, run, most):
    rows = [(-(1 << 63) if d is None else d, (t or "").encode()) for d, t in rows]
    cut = {}
    first = {}
    for k, (doc, text) in enumerate(rows):
        own = [b" ".join(text[a:b].lower().split())
               for a, b in span_dedup.sentences(text, most)]
        cut[k] = own
        for at in range(len(own) - run + 1):
            part = tuple(own[at:at + run])
            first[part] = min(first.get(part, (doc, at)), (doc, at))
    out = []
    for k, (doc, _) in enumerate(rows):
        own = cut[k]
        gone = {at + j for at in range(len(own) - run + 1) for j in range(run)
                if first[tuple(own[at:at + run])] < (doc, at)}
        out.append((doc, len(own), sorted(gone)))
    return sorted(out)


def test_spans_awkward(spark):
    rows = awkward()
    found = span_dedup.remove_spans(documents(spark, rows)).collect()
    got = sorted((-(1 << 63) if r.doc_id is None else r.doc_id, r.n_sentences, r.removed)
                 for r in found)
    assert got == plain_spans(rows, span_dedup.RUN, span_dedup.MOST_WORDS)
    for r in found:
        assert r.n_removed == len(r.removed)


def test_spans_query_and_kept_text(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    found = queries.op1_span_dedup(spark, sf_dir).collect()
    want = plain_spans(docs, span_dedup.RUN, span_dedup.MOST_WORDS)
    assert sorted((r.doc_id, r.n_sentences, r.removed) for r in found) == want
    texts = dict(docs)
    for r in found:
        if not r.removed:
            assert r.kept == texts[r.doc_id]


def test_spans_remove_a_shared_passage_and_leave_the_rest(spark):
    passage = " ".join(f"p{k}" + ("." if k % 9 == 8 else "") for k in range(60))
    rows = [(k, f"{prose(k, 40)}\n{passage}\n{prose(100 + k, 40)}") for k in range(5)]
    found = {r.doc_id: r for r in span_dedup.remove_spans(documents(spark, rows)).collect()}
    assert found[0].kept == rows[0][1]
    for k in range(1, 5):
        assert "p30" not in found[k].kept
        assert all(w in found[k].kept for w in (prose(k, 40) + prose(100 + k, 40)).split())


def test_spans_empty_table(spark):
    assert span_dedup.remove_spans(documents(spark, [])).count() == 0


def test_sentences_cover_all_words():
    text = "A b. C d e f g h i j k l m\nn! o? p.q r\t\x0bs".encode()
    parts = [text[a:b].split() for a, b in span_dedup.sentences(text, 4)]
    assert sum(parts, []) == text.split()
    assert [len(p) for p in parts] == [2, 4, 4, 3, 1, 1, 3]


def plain_long_cut(words, most, worth):
    """Sizes of the parts of a long sentence, by the rule as it is told; ``worth`` per place."""
    half, places = most // 2, len(words) - 1
    fixed = [k for k in range(half, places - half)
             if worth[k] == min(worth[k - half:k + half + 1])
             and worth[k] not in worth[k - half:k]]
    sizes, at = [], -1
    while at < places:
        nxt = min([k for k in fixed if k > at], default=places)
        if nxt - at > most:
            second = range(at + half + 1, at + most + 1)
            nxt = next(k for k in second if worth[k] == min(worth[j] for j in second))
        sizes.append(nxt - at)
        at = nxt
    return sizes


def worths(words):
    """What a cut behind each word is worth, worked out with plain integers."""
    whole = (1 << 64) - 1
    own = [xxhash.xxh3_64_intdigest(w.encode()) for w in words]
    out = []
    for a, b in zip(own, own[1:]):
        x = ((a ^ (b >> 29)) * 0x9E3779B97F4A7C15 + b) & whole
        x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & whole
        out.append(x ^ (x >> 32))
    return out


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 40), st.integers(1, 300), st.integers(1, 9), st.integers(0, 1 << 30))
def test_long_sentences_are_cut_by_their_words(vocabulary, n, most, seed):
    rng = random.Random(seed)
    words = [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
    text = " ".join(w.upper() if rng.random() < 0.2 else w for w in words).encode()
    parts = [text[a:b].lower().split() for a, b in span_dedup.sentences(text, most)]
    assert sum(parts, []) == [w.encode() for w in words]
    sizes = [len(p) for p in parts]
    assert max(sizes) <= most
    if n > 3 * most:
        assert sizes == plain_long_cut(words, most, worths(words))
    else:
        assert sizes == [most] * (n // most) + [n % most] * (n % most > 0)


@pytest.mark.parametrize("words,most_left", [(60, 45), (2000, 45)])
def test_spans_find_a_passage_at_any_offset(spark, words, most_left):
    """Unpunctuated passages in sentences of other words, begun at another place in each."""
    rng = random.Random(words)
    rows, passages = [], {}
    for k in range(100):
        passage = [f"p{k}x{rng.randrange(500)}" for _ in range(words)]
        passages[2 * k + 1] = set(passage)
        for doc in (2 * k, 2 * k + 1):
            around = [[f"o{doc}x{j}x{i}" for i in range(rng.randrange(60))] for j in (0, 1)]
            rows.append((doc, " ".join(around[0] + passage + around[1]) + ". The end."))
    found = {r.doc_id: r for r in span_dedup.remove_spans(documents(spark, rows)).collect()}
    texts = dict(rows)
    for doc, passage in passages.items():
        kept = found[doc].kept.split()
        assert found[doc].n_removed >= 3
        assert sum(w in passage for w in kept) <= most_left
        # nothing around it goes, and the first copy stays whole
        assert [w for w in kept if w not in passage] == \
            [w for w in texts[doc].split() if w not in passage]
        assert found[doc - 1].kept == texts[doc - 1]


def plain_sets(text, size=5):
    words = WORD.findall(lowered(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1)))


def plain_components(rows, threshold=80):
    sets = defaultdict(set)
    for doc, text in rows:
        if doc is not None:
            sets[doc].add(plain_sets(text))
    docs = sorted(sets)
    up = {d: d for d in docs}

    def top(d):
        while up[d] != d:
            d = up[d]
        return d

    lists = defaultdict(set)
    for d in docs:
        for s in sets[d]:
            for x in s:
                lists[x].add(d)
    for a, b in {(a, b) for near in lists.values() for a in near for b in near if a < b}:
        if any(100 * len(x & y) >= threshold * len(x | y)
               for x in sets[a] for y in sets[b] if x and y):
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    return sorted(((d, len(plain_sets(t)), top(d) if d is not None else None) for d, t in rows),
                  key=repr)


def got_components(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def test_join_awkward(spark):
    rows = awkward()
    got = got_components(jaccard_join.jaccard_join(documents(spark, rows)))
    assert got == plain_components(rows)


def test_join_one_id_with_many_texts(spark):
    a, b, c, d = (prose(k, 40) for k in range(50, 54))
    rows = [(2, a), (5, b), (7, d), (9, a), (9, b), (9, c), (9, d), (9, ""), (11, c)]
    got = got_components(jaccard_join.jaccard_join(documents(spark, rows)))
    assert got == plain_components(rows)
    assert {component for _, _, component in got} == {2}


def test_join_small_sets_of_all_sizes(spark):
    rng = random.Random(3)
    rows = []
    for k in range(150):
        base = [f"x{j}" for j in range(rng.randrange(1, 30))]
        for _ in range(rng.randrange(0, 3)):
            base[rng.randrange(len(base))] = f"y{rng.randrange(40)}"
        rows.append((k, " ".join(base)))
    got = got_components(jaccard_join.jaccard_join(documents(spark, rows)))
    assert got == plain_components(rows)


def test_join_chain_of_near_copies(spark):
    words = [f"v{k}" for k in range(200)]
    rows = []
    for k in range(40):  # each differs a little from the one before, a lot from the first
        words[k * 4] = f"new{k}"
        rows.append((40 - k, " ".join(words)))
    rows += [(100 + k, prose(k, 150)) for k in range(10)]
    got = got_components(jaccard_join.jaccard_join(documents(spark, rows)))
    assert got == plain_components(rows)
    assert {c for d, _, c in got if d <= 40} == {1}


@pytest.mark.parametrize("cells", [1, 64])
def test_join_gives_the_same_in_any_order(spark, monkeypatch, cells):
    """Few cells: all shingles seem equally frequent, and none seems to be alone."""
    rows = awkward()
    monkeypatch.setattr(jaccard_join, "CELLS", cells)
    monkeypatch.setattr(jaccard_join, "PACKED_ROWS", 50)
    got = got_components(jaccard_join.jaccard_join(documents(spark, rows)))
    assert got == plain_components(rows)


def test_join_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    assert got_components(queries.op3_jaccard_join(spark, sf_dir)) == plain_components(rows)


def test_join_empty_table(spark):
    assert jaccard_join.jaccard_join(documents(spark, [])).count() == 0


def test_boundary_weighs_subsets_against_postings():
    assert jaccard_join.boundary({}) == 0
    small = jaccard_join.boundary({3: 1000, 4: 1000})
    assert small >= 4
    assert jaccard_join.boundary({24: 1000}) < 24


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 60), st.integers(1, 60), st.data())
def test_needed_is_the_similarity(a, b, data):
    shared = data.draw(st.integers(0, min(a, b)))
    assert (shared >= jaccard_join.needed(a, b)) == (100 * shared >= 80 * (a + b - shared))


def test_components_of_random_links(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)]
    pairs += [(200 + k, 201 + k) for k in range(30)]
    up = {x: x for p in pairs for x in p}

    def top(d):
        while up[d] != d:
            d = up[d]
        return d
    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    got = components.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert sorted((r.node, r.component) for r in got) == sorted((x, top(x)) for x in linked)


def test_no_list_is_turned_into_all_its_pairs(spark, monkeypatch):
    """A thousand near copies of one text: compared with a head, not with one another."""
    words = prose(1, 120).split()
    rows = []
    for k in range(300):
        own = list(words)
        own[k % 120] = f"e{k}"
        rows.append((k, " ".join(own)))
    compared = Counter()
    linked = jaccard_join._linked

    def counted(pairs, *rest):
        compared["pairs"] += pairs.count()
        return linked(pairs, *rest)
    monkeypatch.setattr(jaccard_join, "_linked", counted)
    got = got_components(jaccard_join.jaccard_join(documents(spark, rows)))
    assert {c for _, _, c in got} == {0}
    assert compared["pairs"] < 3 * len(rows)


def test_versions_of_a_text_meet_at_the_one_they_were_made_from(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(150)]
    texts = []
    for k in range(80):
        words = list(base)
        for at in rng.choice(150, 2, replace=False):
            words[at] = f"own{k}x{at}"
        texts.append(" ".join(words))
    rows = [(k, t) for k, t in enumerate([*texts[:40], " ".join(base), *texts[40:]])]
    compared, staged = [], jaccard_join.staged

    def counted(df, name):
        out = staged(df, name)
        if name == "pairs":
            compared.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "staged", counted)
    got = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.component_id for r in got.collect()} == {0}
    assert sum(compared) <= 2 * len(rows)          # their pairs are 3,240
