"""The pipeline, stage by stage."""

import zlib

import corpus_pipeline as pipeline
from tests.llm.cases import awkward, documents, prose
from tests.llm.test_dedup import plain_components
from tests.llm.test_search_and_scan import plain_leaks
from tests.llm.test_tokens_and_mix import plain_files
from tidemark.llm import mixing, quality
from tidemark.llm.common import staged
from tidemark.llm.queries import KEPT_FROM, learnt
from tidemark.plans.registry import table


def ids(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages_in_turn(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    names = docs.columns
    space = learnt(docs, table(spark, sf_dir, "labels"))
    scores = {r["row"].doc_id: r.score
              for r in quality.score(docs, space, keep=["doc_id"]).collect()}
    good = staged(pipeline.keep_good(spark, docs, sf_dir), "good")
    assert good.columns == names
    assert {r.doc_id for r in good.collect()} == {d for d, s in scores.items() if s >= KEPT_FROM}

    rows = [(r.doc_id, r.text) for r in good.collect()]
    one = staged(pipeline.keep_one_of_each(spark, good, sf_dir), "one")
    texts = dict(rows)
    assert one.columns == names
    assert ids(one) == sorted((d, texts[d]) for d, _, c in plain_components(rows) if d == c)

    rows = [(r.doc_id, r.text) for r in one.collect()]
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    clean = staged(pipeline.drop_leaks(spark, one, sf_dir), "clean")
    assert clean.columns == names
    assert sorted(r.doc_id for r in clean.collect()) == sorted(
        d for d, _, hit, _ in plain_leaks(rows, items) if not hit)

    mix = staged(pipeline.mix_sources(spark, clean, sf_dir), "mix")
    assert mix.columns == names
    sizes, taken, most = {}, {}, {}
    for part, into in ((clean, sizes), (mix, taken)):
        for r in part.collect():
            into[r.source] = into.get(r.source, 0) + len(r.text.split())
            most[r.source] = max(most.get(r.source, 0), len(r.text.split()))
    order = sorted(sizes)
    wanted = mixing.repeating_weights(order, [sizes[s] for s in order])
    for source, target in zip(order, wanted):
        assert abs(taken.get(source, 0) - target) <= most[source]

    out = pipeline.token_output(spark, mix, sf_dir).collect()
    rows = [(r.doc_id, r.text) for r in mix.collect()]
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in out) == sorted(
        x[:4] for x in plain_files(rows))


def test_run_is_the_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    assert sorted(docs.collect()) == sorted(pipeline.run(spark, sf_dir).collect())


def tables(tmp_path, spark, rows, labels):
    docs = documents(spark, rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, prose(77, 30))], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_awkward_rows_and_clashing_columns(spark, tmp_path):
    rows = awkward() + [(300, prose(78, 20) + prose(77, 30)), (301, prose(79, 60))]
    rows += [(400 + k, prose(400 + k, 80)) for k in range(30)]
    rows += [(500 + k, "!!! $$$ %%% " * 20) for k in range(30)]
    labels = [(400 + k, 1, 0) for k in range(30)] + [(500 + k, 0, 0) for k in range(30)]
    labels += [(d, 1, 0) for d, t in awkward() if d is not None]
    sf_dir = tables(tmp_path, spark, rows, labels)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        assert docs.columns == names, name
    left = {r.doc_id for r in docs.collect()}
    assert 300 not in left and not any(d and d >= 500 for d in left)
    out = pipeline.token_output(spark, docs, sf_dir).collect()
    assert len(out) == docs.count()


def test_one_of_each_keeps_nulls_and_one_of_repeated_rows(spark):
    rows = [(9, prose(1, 50)), (9, prose(1, 50)), (None, prose(1, 50)), (None, None), (3, None),
            (4, ""), (5, prose(1, 50)), (6, prose(2, 50))]
    got = pipeline.keep_one_of_each(spark, documents(spark, rows), "").collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in got) == [
        (False, 0), (False, 0), (True, 3), (True, 4), (True, 5), (True, 6)]


def test_empty_tables(spark, tmp_path):
    sf_dir = tables(tmp_path, spark, [], [])
    assert pipeline.run(spark, sf_dir).count() == 0


def test_stage_order():
    assert [n for n, _ in pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination",
        "mixing sources", "token-ID output"]
    assert zlib.crc32(b"") == 0 and pipeline.ORACLE_SQL is None
