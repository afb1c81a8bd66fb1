"""From raw documents to coded token files, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all rows of its
predecessor; all but the last return the columns of ``docs``. ``run`` writes
the result of each as Parquet in the shared folder and reads it again, so a
lost executor costs at most a stage. Columns of ``docs`` that happen to be
named like an operator's are kept as they are.

Null texts count as empty, null ids are kept but never taken for copies,
empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard_join, mixing, quality, token_files
from tidemark.llm.common import staged
from tidemark.llm.queries import KEPT_FROM, learnt
from tidemark.plans.registry import query, table
from tidemark.session import scratch

#: SQL can't express the classifier, the mix of its rows or the coded files.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    space = learnt(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, space, keep=docs.columns)
    return scored.where(F.col("score") >= KEPT_FROM).select("row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of least id; of rows that share an id, one."""
    joined = jaccard_join.jaccard_join(docs)
    kept = joined.where(F.col("doc_id") == F.col("component_id")).groupBy(
        F.col("doc_id").alias("key")).agg(F.count("*").alias("times"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       F.col("doc_id").alias("key"))
    # only rows that share an id are sorted by their content
    of_key = Window.partitionBy("key").orderBy(F.xxhash64("row"))
    one = (rows.join(kept.where(F.col("times") > 1), "key", "left_semi")
           .withColumn("nth", F.row_number().over(of_key))
           .where(F.col("nth") == 1).select("row"))
    alone = rows.join(kept.where(F.col("times") == 1), "key", "left_semi").select("row")
    return alone.unionByName(one).unionByName(
        rows.where(F.col("key").isNull()).select("row")).select("row.*")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"), keep=docs.columns)
    return found.where(F.col("n_hit") == 0).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    marks = mixing.placed(F.array(F.col("source").cast("string")))
    mix = mixing.plan_mix(staged(docs.select(*marks), "sizes"), mixing.repeating_weights)
    taken = mixing.with_copies(docs.select(row, *marks), mix)
    return taken.where(F.col("copies") > 0).select(
        "row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The coded token files, told by what is read back from them."""
    path = scratch(spark, "tokens")
    token_files.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.read_tokens(
        spark, path, docs.schema["doc_id"].dataType.simpleString()
    ).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources", mix_sources),
    ("token-ID output", token_output),
]


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
