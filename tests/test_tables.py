"""Catalog facts, publication, layout and archives on catalog tables."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark import fs
from tidemark.operators.layout import bloom_options, cluster
from tidemark.operators.merge import merge_flat
from tidemark.session import scratch, shuffle_partitions, staging, work_dir
from tidemark.sinks import jdbc as jdbc_sink
from tidemark.sinks import orc
from tidemark.sinks.publish import (archive_copy, archive_inputs, create_table, fan_out, refresh,
                                    replace_partitions, stage_and_switch)
from tidemark.sinks.targets import TableTarget
from tidemark.sources import jdbc
from tidemark.sources.tables import (bloom_columns, columns_of, partition_columns, read_table,
                                     snapshot, table_kind)


@pytest.fixture
def table(spark, folder):
    spark.sql("DROP TABLE IF EXISTS facts")
    df = spark.range(100).selectExpr("id", "id * 2 v", "id % 3 p")
    create_table(spark, "facts", df.schema, f"{folder}/facts", ["p"], bloom=["id"])
    orc.write(df, f"{folder}/facts", partition_by=["p"], bloom=["id"])
    refresh(spark, "facts", count_rows=True)
    yield df
    spark.sql("DROP TABLE IF EXISTS facts")


def test_catalog_facts(spark, table):
    assert columns_of(spark, "facts") == [("id", "bigint", False), ("v", "bigint", False),
                                          ("p", "bigint", True)]
    assert partition_columns(spark, "facts") == ["p"]
    assert bloom_columns(spark, "facts") == ["id"]
    assert table_kind(spark, "facts") == "TABLE"
    spark.sql("CREATE OR REPLACE TEMP VIEW facts_view AS SELECT id FROM facts")
    assert table_kind(spark, "facts_view") == "VIEW"
    assert read_table(spark, "facts", ["v"]).columns == ["v"]


def test_refresh_finds_partitions_and_counts(spark, table):
    assert read_table(spark, "facts").count() == 100
    stats = spark.sql("DESCRIBE EXTENDED facts").filter("col_name = 'Statistics'").first()
    assert "100 rows" in stats["data_type"]


def test_switch_reads_its_own_target(spark, folder):
    spark.sql("DROP TABLE IF EXISTS flat")
    df = spark.range(10).selectExpr("id", "'old' v")
    create_table(spark, "flat", df.schema, f"{folder}/s0")
    orc.write(df, f"{folder}/s0")
    refresh(spark, "flat")
    new = spark.range(8, 12).selectExpr("id", "'new' v")
    stage_and_switch(merge_flat(spark.table("flat"), new, ["id"]), "flat", f"{folder}/s1")
    assert spark.table("flat").count() == 12
    assert spark.table("flat").filter("v = 'new'").count() == 4
    assert spark.read.orc(f"{folder}/s0").count() == 10
    spark.sql("DROP TABLE flat")


def test_location_is_not_a_column(spark, folder):
    spark.sql("DROP TABLE IF EXISTS places")
    target = TableTarget(spark, "places", f"{folder}/places")
    target.create(spark.createDataFrame([], "Location string, id int").schema, "load0")
    assert target.location.endswith("/places/load0")
    target.replace(spark.createDataFrame([("x", 1)], "Location string, id int"), "load1")
    assert target.location.endswith("/places/load1") and target.read().count() == 1
    spark.sql("DROP TABLE places")


def test_orc_is_zlib_with_bloom(spark, folder):
    orc.write(spark.range(10).toDF("id"), f"{folder}/o", bloom=["id"], sort_by=["id"])
    assert all(".zlib." in f for f in os.listdir(f"{folder}/o") if f.endswith(".orc"))
    assert bloom_options([]) == {}
    assert bloom_options(["a", "b"])["orc.bloom.filter.columns"] == "a,b"


def test_emptied_partition_is_removed(spark, folder):
    path = f"{folder}/t"
    df = spark.createDataFrame([(1, "a b/c"), (2, "x"), (3, None)], "id int, p string")
    orc.write(df, path, partition_by=["p"])
    target = spark.read.schema(df.schema).orc(path)
    replace_partitions(target.filter("id > 3"), df.filter("id <> 2").select("p"), path, ["p"],
                       may_empty=True)
    assert [r.id for r in spark.read.schema(df.schema).orc(path).collect()] == [2]


def test_archives(spark, folder):
    root = archive_copy(spark.range(3), f"{folder}/a", "t", 5)
    archive_copy(spark.range(4), f"{folder}/a", "t", 6)
    got = {r.load_id: r["count"] for r in spark.read.orc(root).groupBy("load_id").count().collect()}
    assert got == {5: 3, 6: 4}
    os.makedirs(f"{folder}/in")
    open(f"{folder}/in/1-t.csv", "w").close()
    moved = archive_inputs(spark, fs.glob(spark, f"{folder}/in/*-t.csv"), f"{folder}/done", "app",
                           "t", date(2024, 2, 1))
    assert moved == [f"{folder}/done/app/2024-02-01/t/1-t.csv"]
    assert os.listdir(f"{folder}/in") == []


def test_fan_out_gives_every_target_the_same_rows(spark, folder):
    seen = fan_out(spark.range(7), f"{folder}/stage", [(n, lambda df: df.count()) for n in "ab"])
    assert seen == [("a", 7), ("b", 7)]


def test_snapshot_is_a_fixed_state(spark, folder):
    orc.write(spark.range(5), f"{folder}/s")
    view = spark.read.orc(f"{folder}/s")
    copy = snapshot(view)
    orc.write(spark.range(9), f"{folder}/s")
    assert copy.count() == 5


def test_work_dir_is_the_named_one(spark):
    assert work_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert scratch(spark, "x") != scratch(spark, "x")


def test_staging_goes_with_its_step(spark):
    with staging(spark, "step") as path:
        orc.write(spark.range(3), path)
        assert fs.exists(spark, path)
    assert not fs.exists(spark, path)


def test_shuffle_partitions_follow_the_bytes():
    assert shuffle_partitions(10, cores=8) == 8
    assert shuffle_partitions(1 << 40) == 2048
    assert shuffle_partitions(100 << 40, most=50_000) == 50_000


def test_cluster_keeps_partition_order_first(spark):
    plan = cluster(spark.range(10).selectExpr("id", "id % 2 p"), ["p"], (), ["id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in text
    assert text.index("Sort [p") < text.index("Exchange")


def test_jdbc_options():
    lo, hi = datetime(2024, 1, 1), datetime(2024, 2, 1)
    assert jdbc.split_options("at", lo, hi, 8) == {
        "partitionColumn": "at", "lowerBound": "2024-01-01 00:00:00",
        "upperBound": "2024-02-01 00:00:00", "numPartitions": "8"}
    assert jdbc.split_options("at", None, hi, 8) == {}
    assert jdbc.split_options("at", lo, hi, 1) == {}
    options = jdbc.scan_options("jdbc:x", query="select 1", connection={"user": "u"})
    assert options["dbtable"] == "(select 1) src" and options["user"] == "u"
    with pytest.raises(ValueError):
        jdbc.scan_options("jdbc:x", table="t", query="q")
    assert jdbc_sink.write_options("jdbc:x", "t", connections=4)["numPartitions"] == "4"


def test_derived_column_accepts_both_forms(spark):
    from tidemark.operators.columns import with_derived
    df = spark.createDataFrame([(datetime(2024, 3, 1),)], "at timestamp_ntz")
    for form in ("month(at)", "month(at) as m", "month(at) AS `m`", F.month("at")):
        assert with_derived(df, "m", form).first().m == 3


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("load_type", ["FULL", "INCREMENTAL"])
def test_database_statements_do_what_the_merge_does(spark, load_type, null_safe):
    """The generated SQL, run by an embedded SQL library, against the Spark merge."""
    import duckdb

    from tidemark.operators.changes import apply_changes
    from tidemark.operators.keyed import delete_matching
    target = spark.createDataFrame(
        [(1, "old", 0), (2, "old", 0), (3, "old", 0), (None, "old", 0)],
        "k int, v string, hvr_is_deleted int").withColumn(
            "load_ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    batch = spark.createDataFrame(
        [(1, "x", 2, "1"), (1, "y", 2, "2"), (2, "z", 5, "1"), (4, "n", 0, "1"),
         (None, "nul", 1, "1")], "k int, v string, op_code int, time_key string")
    ts = "2024-02-01 00:00:00"
    rows = apply_changes(spark.createDataFrame([], target.schema), batch, ["k"], load_ts=ts)
    want = apply_changes(target, batch, ["k"], load_ts=ts, load_type=load_type,
                         null_safe=null_safe)
    con = duckdb.connect()
    target_arrow = target.toArrow()  # noqa: F841  (read by name below)
    staged_arrow = jdbc_sink.staged_rows(rows, ["k"], batch).toArrow()  # noqa: F841
    con.execute("CREATE TABLE target AS SELECT * FROM target_arrow")
    con.execute("CREATE TABLE staged AS SELECT * FROM staged_arrow")
    for text in jdbc_sink.merge_statements("target", "staged", target.columns, ["k"],
                                           load_type, null_safe):
        con.execute(text)
    got = con.execute("SELECT * FROM target").fetchall()
    assert sorted(map(repr, got)) == sorted(repr(tuple(r)) for r in want.collect())
    assert delete_matching(target, batch, ["k"]).count() == 2


def test_append_files_replace_those_of_the_same_state(spark, folder):
    from tidemark.sinks.publish import append_files
    path = f"{folder}/t"
    base = spark.createDataFrame([(1, "x"), (2, "y")], "id int, p string")
    for part in ([], ["p"]):
        orc.write(base, f"{path}{len(part)}", partition_by=part)
        more = spark.createDataFrame([(3, "x"), (4, "new z")], "id int, p string")
        for _ in range(2):
            append_files(more, f"{path}{len(part)}", "load7", part)
        append_files(more, f"{path}{len(part)}", "load8", part)
        got = spark.read.schema(base.schema).orc(f"{path}{len(part)}")
        assert sorted(r.id for r in got.collect()) == [1, 2, 3, 3, 4, 4]


def test_narrow_fails_unless_asked(spark):
    from tidemark.functions import types as TY
    df = spark.createDataFrame([("5",), ("x",), (None,)], "n string")
    with pytest.raises(Exception, match="column n: does not fit bigint: x"):
        TY.narrow(df, {"n": "bigint"}).collect()
    assert TY.narrow(df, {"n": "bigint"}, on_overflow="null").count() == 3


def test_inputs_of_one_name_are_both_archived(spark, folder):
    from datetime import date

    from tidemark.sinks.publish import archive_inputs
    for turn in ("a", "b"):
        os.makedirs(f"{folder}/in", exist_ok=True)
        with open(f"{folder}/in/1-t.csv", "w") as f:
            f.write(turn)
        archive_inputs(spark, [f"{folder}/in/1-t.csv"], f"{folder}/done", "app", "t",
                       date(2024, 1, 1))
    left = os.listdir(f"{folder}/done/app/2024-01-01/t")
    assert sorted(n for n in left if n.endswith("csv") and n[0] != ".") == ["1-t.csv", "2-1-t.csv"]


def test_database_reads_are_cut_by_what_they_read():
    from tidemark.sources import jdbc

    def whole():
        return 1, 900
    assert jdbc.cuts("INCREMENTAL", "at", 10, 20, 4, whole) == ("at", 10, 20, 4)
    assert jdbc.cuts("INCREMENTAL", "at", None, 20, 4, whole) == ("at", 1, 900, 4)  # first run
    assert jdbc.cuts("FULL", "at", 10, 20, 4, whole) == ("at", 1, 900, 4)
    assert jdbc.cuts("FULL", None, 10, 20, 4, whole) is None
    empty = jdbc.cuts("FULL", "at", 10, 20, 4, lambda: (None, None))
    assert jdbc.split_options(*empty) == {}


def test_null_safe_delete_is_an_equality_and_a_rest():
    from tidemark.sinks.jdbc import merge_statements
    first, second, insert = merge_statements("t", "s", ["a", "b"], ["a", "b"], "INCREMENTAL", True)
    assert " OR " not in first and 'a."a" = b."a" AND a."b" = b."b"' in first
    assert 'AND (b."a" IS NULL OR b."b" IS NULL)' in second and insert.startswith("INSERT")
    full, _ = merge_statements("t", "s", ["a"], ["a"], "FULL", True)
    assert full == "TRUNCATE TABLE t"
