"""Token counts, coded files, mixing and the quality classifier."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.cases import WORD, awkward, documents, prose
from tidemark.llm import mixing, quality, queries, range_coder, token_counts, token_files
from tidemark.plans.registry import table
from tidemark.session import scratch

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

TEXTS = [None, "", " ", "\n\n a", "a  b", "don't they'll 'S x's", "Hello, WORLD!! 123 4",
         "<|endoftext|> x <|startoftext|>y <|endoftext", "a<|endoftext|>  b", "İstanbul ΑΣ ς Ǆ ß",
         "é é   x y​ z", "\x1c\x1d a\x00b \x85c", "漢字 かな 🙂👍🏽", "ab" * 3000,
         "it's 5's ''s !!'s", "x" * 200 + " " * 50 + "y", "tab\tnew\r\nline\x0b\x0c end "]


def test_counts_equal_the_library(spark):
    rows = list(enumerate(TEXTS)) + awkward()
    got = token_counts.count_tokens(documents(spark, rows), WORD_BPE).collect()
    tokenizer = token_counts.open_tokenizer(WORD_BPE)
    want = [(d, len((t or "").encode()),
             len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for d, t in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=40))
def test_counts_of_any_text(text):
    tokenizer = token_counts.open_tokenizer(WORD_BPE)
    known = token_counts._counter(WORD_BPE, token_counts.whole_tokens(WORD_BPE)) \
        if WORD_BPE not in token_counts._open else token_counts._open[WORD_BPE]
    assert known(text) == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_counts_query(spark, sf_dir):
    tokenizer = token_counts.open_tokenizer(WORD_BPE)
    want = {}
    for r in table(spark, sf_dir, "documents").collect():
        n = len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)
        want[r.doc_id] = (len((r.text or "").encode()), n, n > 2048)
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit)
           for r in queries.op6_token_counts(spark, sf_dir).collect()}
    assert got == want


def test_shortcut_is_proved():
    tokenizer = token_counts.open_tokenizer(WORD_BPE)
    whole = token_counts.whole_tokens(WORD_BPE)
    assert len(whole) > 20_000
    assert all(len(tokenizer.encode(w, add_special_tokens=False).ids) == 1
               for w in sorted(whole)[::50])
    assert token_counts.drops_space(WORD_BPE) and not token_counts.drops_space(BYTE_BPE)


def test_counts_without_shortcut_and_empty_table(spark):
    rows = list(enumerate(TEXTS))
    tokenizer = token_counts.open_tokenizer(BYTE_BPE)
    got = token_counts.count_tokens(documents(spark, rows), BYTE_BPE).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {
        d: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for d, t in rows}
    assert token_counts.count_tokens(documents(spark, []), WORD_BPE).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'sa<|> ")),
               max_size=40))
def test_pieces_encode_like_the_whole(text):
    pieces = token_files._pieces(BYTE_BPE)
    assert pieces.of(text) == pieces.encoded(text)


def test_many_texts_are_cut_at_once(monkeypatch):
    """The library is asked for each distinct part once, whatever texts it stands in."""
    words = [" a", " Été", "don't", " 'tis", " we'll", "x''s", "\n", "  \n", " 12a", " \u2009", "ß",
             "日本 go", "<|endoftext|>", " \x00", "'", "\xa0", "×2", " ×", "\t \t", "re's've"]
    rng = np.random.default_rng(5)
    texts = ["".join(words[k] for k in rng.integers(0, len(words), n)) for n in range(60)] * 4
    texts += [None, "", *(" " + w for w in words)]
    pieces = token_files._Pieces(BYTE_BPE)
    ids, sizes = pieces.of_all(pa.array(texts), 2)
    want = [[*pieces.tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want

    asked = []
    many = pieces._many
    monkeypatch.setattr(pieces, "_many", lambda parts: asked.extend(parts) or many(parts))
    pieces.forget()
    plain = pa.array([f" word{k % 7} of {k % 3}" for k in range(500)])
    assert pieces.of_all(plain, 2)[1].sum() > 1500
    pieces.of_all(plain, 2)
    assert len(asked) == len(set(asked)) == 5  # word, of and three digits, with their blanks


def test_many_parts_make_one_word_for_the_library():
    """No merge leads over the blank a part begins with, so that the parts of a word stay apart."""
    pieces = token_files._Pieces(BYTE_BPE)
    assert pieces.joins
    rng = np.random.default_rng(3)
    letters = [*"aeinrstdlThE'~|-=_019", "é", "ß", "ª", "à", "ÿ"]
    parts = {" " + "".join(letters[k] for k in rng.integers(0, len(letters), n))
             for n in rng.integers(1, 12, 4000)}
    texts = [x for part in sorted(parts) for x in (part, part + part, part[1:] + "\n" + part)]
    words = []

    class Asked:
        def encode_batch_fast(self, own, **rest):
            words.extend(own)
            return bare.encode_batch_fast(own, **rest)

    bare, pieces.bare = pieces.bare, Asked()
    ids, sizes = pieces.of_all(pa.array(texts), 2)
    assert [x[:-1].tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [
        pieces.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert 0 < len(words) < len(parts) // 20


def test_parts_are_told_apart_over_many_batches(monkeypatch):
    pieces = token_files._Pieces(BYTE_BPE)
    batches = [pa.record_batch({"id": [k], "text": pa.array([t], pa.string())})
               for k, t in enumerate(TEXTS * 3)]
    (own, cuts), = token_files._parted(pieces, batches)
    assert own.to_pylist() == list(range(len(batches)))
    want = pieces.of_all(pa.array(TEXTS * 3), 2)
    pieces.forget()
    got = pieces.of_cuts(cuts, 2)
    assert all((a == b).all() for a, b in zip(got, want, strict=True))
    assert len(set(pieces.parts.to_pylist())) == len(pieces.parts)
    monkeypatch.setattr(token_files, "PARTED_BYTES", 50)
    apart = list(token_files._parted(pieces, batches))
    assert len(apart) > 3 and sum(len(own) for own, _ in apart) == len(batches)
    assert (np.concatenate([pieces.of_cuts(cuts, 2)[0] for _, cuts in apart]) == want[0]).all()


@pytest.mark.parametrize("known", [1, 2, 1 << 14, (1 << 14) + 1, 150_000])
def test_coder_of_few_and_many_ranks(known):
    """Ranks that fit share a narrow table with how sure they are."""
    rng = np.random.default_rng(known)
    ids = np.concatenate([np.arange(known), rng.integers(0, known, 9000),
                          np.tile(rng.integers(0, known, 50), 200)]).astype(np.uint32)
    assert (range_coder.decode(range_coder.encode(ids)) == ids).all()
    table = range_coder._Model(3, known).follows
    assert table.dtype == (np.uint16 if known <= 1 << 14 else np.uint32)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 20), st.integers(0, 2**28 - 1)), max_size=400))
def test_coder_round_trip(ids):
    ids = np.array(ids, np.uint32)
    assert (range_coder.decode(range_coder.encode(ids)) == ids).all()


@pytest.mark.parametrize("n", [1, 4095, 4096, 4097, 3 * 4096 + 5])
def test_coder_blocks(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 50_000).astype(np.uint32)
    group = range_coder.encode(ids)
    assert (range_coder.decode(group) == ids).all()
    blocks = -(-n // range_coder.BLOCK)
    for k in range(blocks):  # any block alone
        own = range_coder.decode(group, slice(k, k + 1))
        assert (own == ids[k * range_coder.BLOCK:(k + 1) * range_coder.BLOCK]).all()


def test_coder_sees_damage_and_compresses():
    ids = np.tile(np.arange(50, dtype=np.uint32), 400)
    group = range_coder.encode(ids)
    assert len(group.words) < len(ids)  # under 8 bits an id of 32
    words = bytearray(group.words)
    words[len(words) // 2] ^= 1
    with pytest.raises(ValueError):
        range_coder.decode(group._replace(words=bytes(words)))


def test_coder_keeps_the_larger_part_of_a_cut_span():
    rng = np.random.default_rng(11)
    ids = (rng.zipf(1.2, 60_000) % 4_000).astype(np.uint32)
    group = range_coder.encode(ids)
    assert (range_coder.decode(group) == ids).all()
    assert len(group.words) < 63140  # bytes when the lower part was kept


def plain_files(rows, end=2):
    tokenizer = token_counts.open_tokenizer(BYTE_BPE)
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_files_awkward(spark, monkeypatch):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(100 + d, t) for d, t in awkward()
                                                    if d is not None and d not in (9,)]
    path = scratch(spark, "tokens")
    token_files.write_tokens(documents(spark, rows), path, BYTE_BPE, 2, shard_bytes=20_000)
    got = token_files.read_tokens(spark, path, with_ids=True).collect()
    assert sorted(tuple(r) for r in got) == sorted(plain_files(rows))


def test_workers_keep_no_parts_after_their_task(spark):
    """A worker may wait, or serve the next stage, for long; only the tokenizer stays in it."""
    rows = [(k, f"plain words and number {k}") for k in range(200)]
    token_files.write_tokens(documents(spark, rows), scratch(spark, "tokens"), BYTE_BPE, 2)

    def held(batches):
        for batch in batches:
            kept = [len(found) for p in token_files._open.values() for found in vars(p).values()
                    if isinstance(found, dict) and any(isinstance(k, str | bytes) for k in found)]
            yield pa.RecordBatch.from_arrays([pa.array([sum(kept)] * batch.num_rows, pa.int64())],
                                             names=["kept"])

    seen = spark.range(0, 64, 1, 16).mapInArrow(held, "kept long").collect()
    assert {r.kept for r in seen} == {0}


def test_files_with_repeated_and_null_ids(spark):
    rows = awkward()
    path = scratch(spark, "tokens")
    token_files.write_tokens(documents(spark, rows), path, BYTE_BPE, 2)
    got = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.id for r in got] == sorted((d for d, _ in rows),
                                         key=lambda d: (d is not None, d or 0))
    for a, b in zip(got, got[1:]):
        assert b.start == a.start + a.n_tokens
    assert sorted(r.ids_crc32 for r in got) == sorted(x[3] for x in plain_files(rows))


def test_files_query_and_empty_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    got = queries.op10_token_files(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == sorted(
        x[:4] for x in plain_files(rows))
    path = scratch(spark, "tokens")
    token_files.write_tokens(documents(spark, []), path, BYTE_BPE, 2)
    assert token_files.read_tokens(spark, path).count() == 0


def test_targets_share_by_weight_and_stop_at_the_cap():
    assert mixing.water_fill([100, 100, 100], [5, 2, 1]) == [187.5, 75.0, 37.5]
    got = mixing.water_fill([10, 1000, 1000], [5, 2, 1])
    assert got[0] == 30 and got[1] == pytest.approx(2 * got[2]) and sum(got) == pytest.approx(2010)
    assert mixing.water_fill([0, 7], [5, 2]) == [0.0, 7.0]
    assert mixing.water_fill([0, 0], [5, 2]) == [0.0, 0.0]


def plain_cost(capacity, routed):
    total = 0
    for size, flow in zip(capacity, routed):
        words = sum(flow.values())
        for copy in range(3):
            part = min(size, max(0, words - copy * size))
            total += copy * part
    return total


def test_route_spreads_overlap_at_least_cost():
    # source 0 has its own 10 words and shares 20 with source 1
    routed = mixing.route([10, 20], [[0], [0, 1]], [15, 15])
    assert sum(routed[0].values()) == 10 and routed[1] == {0: 5, 1: 15}
    assert plain_cost([10, 20], routed) == 0
    routed = mixing.route([10, 20], [[0], [0, 1]], [100, 20])
    assert sum(sum(f.values()) for f in routed) == 90  # all there is, three times


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.sets(st.integers(0, 2), min_size=1)),
                min_size=1, max_size=3), st.lists(st.integers(0, 8), min_size=3, max_size=3))
def test_route_is_cheapest(patterns, quotas):
    capacity, members = [c for c, _ in patterns], [sorted(m) for _, m in patterns]
    routed = mixing.route(capacity, members, quotas)
    taken = [sum(f.get(s, 0) for f in routed) for s in range(3)]
    assert all(t <= q for t, q in zip(taken, quotas))
    best = {}  # by trying all amounts, pattern after pattern
    state = {(0, 0, 0): 0}
    for size, own in zip(capacity, members):
        step = defaultdict(lambda: 10**9)
        for have, cost in state.items():
            options = [have]
            for _ in range(3 * size + 1):
                for x in options:
                    words = sum(x) - sum(have)
                    extra = sum(k * min(size, max(0, words - k * size)) for k in range(3))
                    step[x] = min(step[x], cost + extra)
                options = list({tuple(v + (s == t) for t, v in enumerate(x))
                                for x in options for s in own if x[s] < quotas[s]})
                if not options:
                    break
        state = step
    most = max(sum(x) for x in state)
    best = min(c for x, c in state.items() if sum(x) == most)
    assert sum(taken) == most and plain_cost(capacity, routed) == best


def mixed(spark, docs):
    sized = docs.select("doc_id", *mixing.placed(F.array(F.col("source").cast("string"))))
    mix = mixing.plan_mix(sized, mixing.repeating_weights)
    return mixing.with_copies(sized, mix).collect(), mix


def test_mix_awkward(spark):
    rows = [(k, prose(k, 3 + k % 40), "en", "abc"[k % 3]) for k in range(300)]
    rows += [(None, "x y", "en", None), (500, None, None, None), (501, "", "en", ""),
             (502, prose(9, 5000), "en", "a"), (7, prose(7, 10), "en", "b"),
             (7, prose(7, 10), "en", "b")]
    got, mix = mixed(spark, documents(spark, rows))
    assert len(got) == len(rows)
    sizes, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        source = r.members[0]
        assert 0 <= r.copies <= 3 and (r["size"] or not r.copies)
        sizes[source] += r["size"]
        taken[source] += r["size"] * r.copies
        longest[source] = max(longest[source], r["size"])
    assert list(mix.sources) == ["", "a", "b", "c", None]
    for source, (size, target) in mix.sources.items():
        assert size == sizes[source]
        assert abs(taken[source] - target) <= longest[source] / 2 + 20  # shared ids go together
    again, _ = mixed(spark, documents(spark, rows).repartition(7))
    assert sorted(map(repr, got)) == sorted(map(repr, again))


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 5), max_size=12), st.integers(0, 200))
def test_no_document_left_out_would_fill_better(sizes, owed):
    taken = mixing.fill(owed, sizes)
    assert all(0 < n <= sizes[size] for size, n in taken.items())
    left = owed - sum(size * n for size, n in taken.items())
    for size, n in sizes.items():
        if taken.get(size, 0) < n:
            assert abs(left - size) >= abs(left)


def test_mix_passes_over_a_document_longer_than_what_is_owed(spark):
    """It comes first by hash; many small ones behind it fit."""
    rows = [(k, "w " * 10, "en", "s") for k in range(400)]
    docs = documents(spark, rows).withColumn("text", F.when(
        F.col("doc_id") == 0, F.repeat(F.lit("w "), 20_000)).otherwise(F.col("text")))
    sized = docs.select("doc_id", *mixing.placed(F.array("source"))).withColumn(
        "seeded", F.when(F.col("doc_id") == 0, F.lit("0" * 32)).otherwise(F.col("seeded")))
    mix = mixing.plan_mix(sized, lambda names, sizes: [3007.0])
    got = mixing.with_copies(sized, mix).where("copies > 0").collect()
    assert sum(r["size"] * r.copies for r in got) == 3010 and all(r.doc_id for r in got)


def test_sources_of_the_query_come_near_their_targets(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.01")
    source = table(spark, big, "documents").select("doc_id", "source")
    found = queries.op8_mix(spark, big).join(source, "doc_id").groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"))
    for r in found.collect():
        assert abs(r.taken - r.target) <= 0.02 * r.target


def test_mix_overlapping_sources(spark):
    rows = [(k, prose(k, 20), "en", "s") for k in range(60)]
    docs = documents(spark, rows)
    of = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("x"), F.lit("y"))).when(
        F.col("doc_id") % 3 == 1, F.array(F.lit("x"))).otherwise(F.array(F.lit("y")))
    sized = docs.select("doc_id", *mixing.placed(of))
    mix = mixing.plan_mix(sized, lambda names, sizes: [600.0, 300.0])
    taken = sum(r["size"] * r.copies for r in mixing.with_copies(sized, mix).collect())
    assert abs(taken - 900) <= 30
    assert sum(w for _, s, w in mix.routes if s == "x") == 600


def test_mix_empty(spark):
    got, mix = mixed(spark, documents(spark, []))
    assert got == [] and mix.sources == {}


def test_quality_held_out(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.1")
    docs = table(spark, big, "documents")
    labels = table(spark, big, "labels")
    got = queries.op9_quality(spark, big)
    assert got.count() == docs.count()
    known = got.where("held_out").join(labels, "doc_id").collect()
    assert len(known) > 500
    assert np.mean([r.predicted == r.quality for r in known]) > 0.98
    good = [r for r in known if r.quality == 1]
    assert np.mean([r.predicted for r in good]) > 0.99
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in known)
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in known)


def test_quality_awkward(spark):
    rows = awkward() + [(100 + k, prose(k, 50)) for k in range(20)] + [
        (200 + k, "!!! $$$ " * 30) for k in range(20)]
    docs = documents(spark, rows)
    labels = [(100 + k, 1) for k in range(20)] + [(200 + k, 0) for k in range(20)] + [
        (5, None), (None, 1), (999, 1), (100, 1), (9, 7)]
    taught = spark.createDataFrame(labels, "doc_id long, quality int")
    space = quality.learn(docs, taught)
    assert len(space.labels) == 40
    got = quality.score(docs, space, keep=["doc_id", "text"]).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r["row"].doc_id: r.score for r in got}
    assert by[-4] > 0.9 and by[205] < 0.1
    none = spark.createDataFrame([], "doc_id long, quality int")
    flat = quality.score(docs, quality.learn(docs, none), keep=["doc_id"])
    assert {r.score for r in flat.collect()} == {0.5}
    empty = documents(spark, [])
    assert quality.score(empty, quality.learn(empty, taught), keep=["doc_id"]).count() == 0


def test_quality_bounds_the_labelled_rows(spark):
    docs = documents(spark, [(k, prose(k, 20)) for k in range(50)])
    taught = spark.createDataFrame([(k, k % 2) for k in range(50)], "doc_id long, quality int")
    assert len(quality.learn(docs, taught, labelled_rows=10).labels) == 10


def test_votes_are_exact_neighbours():
    rng = np.random.default_rng(0)
    counts = rng.poisson(1.0, (60, quality.TERMS)).astype(np.float32)
    labels = rng.integers(0, 2, 60)
    idf = np.ones(quality.TERMS, np.float32)
    space = quality.fit(counts[:40], labels[:40], idf, 8)
    got = quality.votes(counts[40:], space, 5, block=7)
    own = quality._unit(quality.weighted(counts[40:], idf) @ space.axes)
    for row, score in zip(own, got):
        likeness = space.vectors @ row
        near = np.argsort(-likeness)[:5]
        w = np.maximum(likeness[near], 0).astype(float) ** quality.SHARPNESS + 1e-9
        assert score == pytest.approx((w * space.labels[near]).sum() / w.sum(), abs=1e-4)


def test_empty_text_counts_terms():
    counts = quality.term_counts([b"", b"a b"])
    assert counts[0].sum() > 0 and WORD.findall("a b") == ["a", "b"]


def test_words_met_are_kept_by_the_task_only():
    assert not any(isinstance(x, dict) and type(x) is not dict for x in vars(quality).values())
    known = quality._Terms()
    first = quality.term_counts([b"one two"], known)
    assert set(known) == {b"one", b"two"}
    assert (first == quality.term_counts([b"one two"])).all()
