"""The registered queries: each operator over its whole table, with the SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    collocations,
    decontaminate,
    jaccard_join,
    licenses,
    merkle,
    mixing,
    quality,
    span_dedup,
    suffix_dedup,
    token_counts,
    token_files,
    topk_search,
    url_filter,
)
from tidemark.llm.common import staged
from tidemark.llm.sql import (COLLOCATIONS_SQL, LEAKS_SQL, MANIFEST_SQL, MIX_SQL, TOPK_SQL,
                              license_sql, url_sql)
from tidemark.plans.registry import query, table
from tidemark.session import scratch


#: Score from which a document counts as good.
KEPT_FROM = 0.7


def held_out(doc_id: F.Column) -> F.Column:
    """Rows that no label is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learnt(docs: DataFrame, labels: DataFrame) -> quality.Space:
    return quality.learn(docs, labels.where(~held_out(F.col("doc_id"))))


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"),
                                        public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


@query("op7_decontaminate", LEAKS_SQL)
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"),
                                     table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@query("op8_mix", MIX_SQL)
def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    source = F.col("source").cast("string")
    sized = staged(docs.select("doc_id", *mixing.placed(F.array(source))), "sizes")
    mix = mixing.plan_mix(sized, mixing.repeating_weights)
    figures = mixing.source_table(spark, mix)
    chosen = mixing.with_copies(sized, mix).withColumn("source", F.element_at("members", 1))
    return (chosen.join(figures, chosen["source"].eqNullSafe(figures["source"]))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * F.col("copies")).alias("taken")))


@query("op10_token_files")
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = scratch(spark, "tokens")
    token_files.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.read_tokens(
        spark, path, docs.schema["doc_id"].dataType.simpleString()
    ).withColumnRenamed("id", "doc_id")


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, learnt(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return scored.select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score",
        (F.col("score") >= KEPT_FROM).cast("int").alias("predicted"))


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        (F.size("spans") / 2).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


@query("op1_span_dedup")
def op1_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup.remove_spans(table(spark, sf_dir, "documents"))


@query("op3_jaccard_join")
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))
    return joined.select("doc_id", "n_shingles", "component_id", "class_id")


@query("op2_topk_search", TOPK_SQL)
def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def document_path() -> F.Column:
    """Documents as a file tree: source, language, then the digits of the id."""
    return F.concat(F.lit("/"), F.coalesce(F.col("source").cast("string"), F.lit("_")),
                    F.lit("/"), F.coalesce(F.col("lang").cast("string"), F.lit("_")),
                    F.regexp_replace(F.coalesce(F.col("doc_id").cast("string"), F.lit("_")),
                                     "(.)", "/$1"))


@query("op5_license_scan", license_sql(licenses.TEMPLATES, licenses.SIMILARITY,
                                       licenses.FILE_SHARE))
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), document_path(), keep=["doc_id"])


#: Host, path and verdict.
URL_RULES = [
    ("com", "/", url_filter.ALLOW), ("example.com", "/en/", url_filter.BLOCK),
    ("www.example.com", "/en/", url_filter.ALLOW), ("net", "/es/", url_filter.BLOCK),
    ("net", "/fr/", url_filter.BLOCK)]


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules as rows whose size Spark knows."""
    row = F.explode(F.array(*(F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"),
                                       F.lit(v).alias("verdict")) for h, p, v in rules)))
    return spark.range(1).select(row.alias("rule")).select("rule.*")


@query("op11_url_filter", url_sql(URL_RULES, url_filter.ALLOW))
def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages"), rule_table(spark, URL_RULES),
                              keep=["page_id"])
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


@query("op12_collocations", COLLOCATIONS_SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.best(collocations.mine(table(spark, sf_dir, "documents")), 2000)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@query("op13_merkle_manifest", MANIFEST_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 2 divides the id's checksum the presented text has lost its line breaks."""
    docs = table(spark, sf_dir, "documents")
    text, others = F.col("text"), [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    shown = F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    proved = merkle.prove(docs, merkle.leaf_digest(*others, text), tree=F.col("source"),
                          order=F.col("doc_id"),
                          keep=[F.col("doc_id"), merkle.leaf_digest(*others, shown).alias("shown")])
    return proved.select(
        "row.doc_id", "leaf", "subroot", "root",
        merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        merkle.fold(F.col("row.shown"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
