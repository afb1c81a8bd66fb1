"""What Spark does with the plans: pruning, pushdown, pre-aggregation, hot keys."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators import merge as M
from tidemark.operators.extract import window_filter
from tidemark.operators.keyed import delete_matching, latest_per_key
from tidemark.operators.metrics import merge_metrics
from tidemark.sinks import orc
from tidemark.sources.tables import read_orc

PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan adaptive execution ended with."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()
    return execution.executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture
def no_broadcast(spark):
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
             "spark.sql.shuffle.partitions": "16"}
    old = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in old.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    if name.startswith("stream_"):
        pytest.skip("its plan is only a read of the published version")
    text = plan(entry.queries()[name](spark, sf_dir))
    assert not any(p in text for p in PYTHON)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.fixture
def hot(spark):
    """A third of all rows share one key, and another third have none."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 2, F.col("id"))
    return spark.range(0, 120000, 1, 16).select(key.alias("k"), F.col("id").alias("v"))


@pytest.mark.parametrize("null_safe", [True, False])
def test_hot_target_key_is_split(spark, no_broadcast, hot, null_safe):
    incoming = spark.range(0, 30000, 1, 8).select((F.col("id") * 3 + 2).alias("k"))
    out = delete_matching(hot, incoming, ["k"], null_safe=null_safe)
    assert "skew=true" in final_plan(out)
    assert out.count() == 120000 - 30000


def test_rows_outside_the_key_range_are_not_shuffled(spark, no_broadcast, folder):
    orc.write(spark.range(100000).selectExpr("id k", "id v"), f"{folder}/t")
    target = read_orc(spark, f"{folder}/t")
    incoming = spark.range(99000, 101000).selectExpr("id k", "-id v")
    out = M.merge_flat(target, incoming, ["k"], range_key="k")
    joined, rest = plan(out).split("Scan orc")[1:]
    assert "GreaterThanOrEqual(k,99000)" in joined and "LessThanOrEqual(k,100999)" in joined
    assert "Exchange" not in rest.split("Range")[0]
    assert out.count() == 101000


def test_hot_incoming_key_is_reduced_before_the_shuffle(spark, no_broadcast, hot):
    out = delete_matching(spark.range(50).toDF("k"), hot, ["k"])
    text = plan(out)
    right = text[text.index("__key_0"):]
    assert right.count("HashAggregate") == 2 and right.count("Exchange") >= 2
    assert out.count() == 50 - len({7, *[i for i in range(50) if i % 3 == 2]})


def test_latest_per_key_limits_before_the_shuffle(hot):
    text = plan(latest_per_key(hot, ["k"], "v"))
    assert text.index("Partial") > text.index("Exchange") > text.index("Final")


def test_metrics_shuffle_once_without_a_join(hot):
    text = plan(merge_metrics(hot, hot, ["k"]))
    assert "Join" not in text
    assert text.count("Exchange hashpartitioning") == 1


def test_small_incoming_side_spares_the_target_a_shuffle(spark, sf_dir):
    target = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    incoming = spark.read.parquet(f"{sf_dir}/supplier.parquet").withColumnRenamed("s_suppkey", "l_suppkey")
    text = plan(delete_matching(target, incoming, ["l_suppkey"]))
    left = text[:text.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in left and "Exchange hashpartitioning" not in left


def test_window_reaches_the_scan(spark, sf_dir):
    rows = window_filter(spark.read.parquet(f"{sf_dir}/events.parquet"), "ts",
                         "2024-01-05 00:00:00", "2024-01-06 00:00:00").select("event_id")
    text = plan(rows)
    pushed = text[text.index("PushedFilters"):]
    assert "GreaterThan(ts" in pushed and "LessThanOrEqual(ts" in pushed
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_partitioned_merge_reads_only_its_partitions(spark, folder):
    path = f"{folder}/t"
    orc.write(spark.range(1000).selectExpr("id", "id % 10 p"), path, partition_by=["p"])
    target = read_orc(spark, path)
    incoming = spark.range(3, 1000, 10).selectExpr("id", "cast(id % 10 as int) p")
    text = plan(M.merge_partitioned(target, incoming, ["id"], ["p"]))
    assert "(p" in text.split("PartitionFilters")[1] and ">= 3)" in text and "<= 3)" in text


def test_many_partitions_prune_by_range(spark, folder):
    path = f"{folder}/t"
    orc.write(spark.range(1000).selectExpr("id", "id % 20 p"), path, partition_by=["p"])
    target = read_orc(spark, path)
    incoming = spark.range(1000).selectExpr("id", "cast(5 + id % 3 as int) p")
    out = M.prune_to(target, M.affected_partitions(incoming, ["p"]), ["p"])
    assert "(p" in plan(out).split("PartitionFilters")[1] and ">= 5)" in plan(out)
    assert "LeftSemi" in plan(out)
    assert out.count() == 150


def test_hot_partition_is_written_by_several_tasks(spark, no_broadcast, folder):
    import os
    df = spark.range(0, 200000, 1, 16).selectExpr(
        "id", "uuid() v", "case when id % 3 = 0 then 0 else id % 50 end p")
    orc.write(df, f"{folder}/t", partition_by=["p"], sort_by=["id"])
    files = {d: len(os.listdir(f"{folder}/t/{d}")) for d in os.listdir(f"{folder}/t")
             if d.startswith("p=")}
    assert files["p=0"] > 4
    assert read_orc(spark, f"{folder}/t").count() == 200000


def test_text_line_is_split_once(spark, folder):
    from pyspark.sql import types as T

    from tidemark.functions import text as X
    from tidemark.sources.text import read_soh
    schema = T.StructType.fromDDL("a int, b string, c double, d string")
    spark.createDataFrame([("1\x01x\x012.0\x01y",)], "value string").write.text(f"{folder}/t")
    text = plan(read_soh(spark, f"{folder}/t", schema))
    assert text.count("split(") == 1 and X.SOH


def test_partitions_with_moved_keys_merge_once(spark, folder):
    from tidemark.sinks import publish
    path = f"{folder}/t"
    orc.write(spark.range(100).selectExpr("id", "id % 5 p"), path, partition_by=["p"])
    target = read_orc(spark, path)
    incoming = spark.range(0, 100, 5).selectExpr("id", "cast(1 as int) p")
    touched = M.touched_partitions(target, incoming, ["id"], ["p"])
    merged = M.merge_partitioned_global(target, incoming, ["id"], ["p"])
    publish.replace_partitions(merged, touched, path, ["p"], may_empty=True)
    left = read_orc(spark, path)
    assert left.count() == 100
    assert {r.p for r in left.select("p").distinct().collect()} == {1, 2, 3, 4}
