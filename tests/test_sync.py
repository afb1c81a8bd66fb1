"""Control rows run end to end against catalog tables."""

from datetime import datetime

import pytest
from pyspark.sql import types as T

from tidemark import fs
from tidemark.control import audit
from tidemark.control import table as CT
from tidemark.plans.cli import main
from tidemark.plans.sync import (LoadSpec, check_target_schema, load_drops, loader_for, run_due)
from tidemark.sinks.publish import Versions, drop_files
from tidemark.sinks.targets import TableTarget

T0, T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 10), datetime(2024, 1, 20)
FIELDS = "id int, v string, at timestamp_ntz, hvr_is_deleted int"


def control_row(spark, **values):
    schema = spark.createDataFrame([], CT.SCHEMA).schema
    base = dict(id=1, load_group_id=1, source_schemaname="app", source_tablename="things",
                target_schemaname="app", target_tablename="things", data_path="GP2HDFS",
                load_type="INCREMENTAL", incremental_column="at", join_columns="id",
                last_run_time=T1, second_last_run_time=T0, hvr_last_processed_value=T2,
                status_flag="Y", is_partitioned=False, s3_backed=False, archived_enabled=False)
    base.update(values)
    return tuple(base.get(n) for n in schema.names)


@pytest.fixture
def world(spark, folder):
    spark.sql("CREATE DATABASE IF NOT EXISTS app")
    spark.sql("DROP TABLE IF EXISTS app.things")
    source = spark.createDataFrame([
        (1, "one", T0, 0), (2, "two", datetime(2024, 1, 5), 0), (3, "three", datetime(2024, 1, 15), 0),
        (4, "four", datetime(2024, 1, 16), 1), (5, "later", datetime(2024, 1, 30), 0)], FIELDS)

    class World:
        control = Versions(spark, f"{folder}/control")
        audit_path = f"{folder}/audit"
        target = TableTarget(spark, "app.things", f"{folder}/things")
        rows = source

        def save(self, *rows):
            schema = spark.createDataFrame([], CT.SCHEMA).schema
            self.control.publish(spark.createDataFrame(list(rows), schema), 1)

        def state(self):
            return self.control.read(spark.createDataFrame([], CT.SCHEMA).schema).collect()

        def run(self, load_type="INCREMENTAL", route="GP2HDFS", load_id=7, **more):
            return run_due(spark, self.control, self.audit_path, route=route, schema="app",
                           load_type=load_type, now=T2, load_id=load_id,
                           source_of=lambda spec: self.rows, target_of=lambda spec: self.target,
                           **more)

        def values(self):
            spark.catalog.refreshTable("app.things")
            return sorted((r.id, r.v) for r in self.target.read().collect())

    yield World()
    spark.sql("DROP TABLE IF EXISTS app.things")


def test_full_creates_the_target(world):
    world.save(control_row(world.control.spark, load_type="FULL"))
    (done,) = world.run("FULL")
    assert done.error is None and done.rows == 5
    assert len(world.values()) == 5
    assert world.target.read().columns[-4:] == ["hive_updated_by", "hive_updated_date", "op_code",
                                                "time_key"]


def _seed(world, rows, partition=None, **row):
    spark = world.control.spark
    world.save(control_row(spark, load_type="FULL", **row))
    keep, world.rows = world.rows, spark.createDataFrame(rows, FIELDS)
    world.run("FULL", load_id=1)
    world.rows = keep


def test_incremental_merges_window_and_advances(world):
    spark = world.control.spark
    _seed(world, [(1, "old", T0, 0), (2, "old", T0, 0), (9, "kept", T0, 0)])
    world.control.publish(spark.createDataFrame(
        [control_row(spark)], spark.createDataFrame([], CT.SCHEMA).schema), 50)
    (done,) = world.run()
    assert done.error is None and done.rows == 3      # (T0, T2]: ids 2, 3, 4
    assert world.values() == [(1, "old"), (2, "two"), (3, "three"), (4, "four"), (9, "kept")]
    (row,) = world.state()
    assert (row.last_run_time, row.second_last_run_time, row.load_status_cd) == (T2, T1, "C")
    assert world.run() == []                           # nothing newer at the source


def test_repeating_an_incremental_load_changes_nothing(world):
    spark = world.control.spark
    _seed(world, [(2, "old", T0, 0)])
    schema = spark.createDataFrame([], CT.SCHEMA).schema
    for version, load_id in ((50, 2), (60, 2), (70, 3)):
        world.control.publish(spark.createDataFrame([control_row(spark)], schema), version)
        (done,) = world.run(load_id=load_id)
        assert done.error is None
    assert world.values() == [(2, "two"), (3, "three"), (4, "four")]
    # the current state and the one before it
    assert fs.names(spark, world.target.root) == ["load2-2", "load3"]


def test_append_takes_live_rows_after_the_last_run(world):
    spark = world.control.spark
    _seed(world, [(1, "old", T0, 0)])
    schema = spark.createDataFrame([], CT.SCHEMA).schema
    world.control.publish(spark.createDataFrame([control_row(spark, load_type="APPEND_ONLY")],
                                                schema), 50)
    (done,) = world.run("APPEND_ONLY")
    assert done.error is None
    assert world.values() == [(1, "old"), (3, "three")]


def test_partitioned_incremental_rewrites_its_partitions(world, folder):
    spark = world.control.spark
    part = dict(is_partitioned=True, first_partitioned_column="m",
                partition_column_transformation="month(at) as m", archived_enabled=True)
    _seed(world, [(1, "old", datetime(2023, 12, 1), 0), (2, "old", datetime(2024, 1, 2), 0),
                  (8, "kept", datetime(2024, 1, 3), 0)], **part)
    assert world.target.partition_by == ["m"]
    schema = spark.createDataFrame([], CT.SCHEMA).schema
    world.control.publish(spark.createDataFrame([control_row(spark, **part)], schema), 50)
    (done,) = world.run(archive_root=f"{folder}/archive")
    assert done.error is None
    assert world.values() == [(1, "old"), (2, "two"), (3, "three"), (4, "four"), (8, "kept")]
    assert {r.m for r in world.target.read().select("m").distinct().collect()} == {1, 12}
    assert spark.read.orc(f"{folder}/archive/app/things_bkp").count() == 5


def test_failure_is_marked_and_logged(world):
    spark = world.control.spark
    _seed(world, [(1, "old", T0, 0)])
    schema = spark.createDataFrame([], CT.SCHEMA).schema
    world.control.publish(spark.createDataFrame([control_row(spark, join_columns="nope")],
                                                schema), 50)
    (done,) = world.run()
    assert "nope" in done.error
    (row,) = world.state()
    assert (row.load_status_cd, row.last_run_time) == ("E", T1)
    log = audit.read(spark, world.audit_path)
    assert [r.failed_tables for r in audit.failed_tables(log, 7).collect()] == ["app.things"]
    assert log.filter("status = 'Job Error' and number_of_errors = 1").count() == 1
    assert world.values() == [(1, "old")]


def test_change_route_applies_and_signals_the_next_route(world, spark):
    at = "timestamp_ntz'2024-01-01 00:00:00'"
    target = TableTarget(spark, "app.things", world.target.root)
    base = spark.sql(f"select 1 id, 'old' v, 0 hvr_is_deleted, {at} load_ts "
                     f"union all select 2, 'kept', 0, {at}")
    target.redefine(base, "start")
    schema = spark.createDataFrame([], CT.SCHEMA).schema
    world.control.publish(spark.createDataFrame(
        [control_row(spark, data_path="SRC2GP"),
         control_row(spark, id=2, hvr_last_processed_value=T0)], schema), 50)
    world.rows = spark.createDataFrame([(1, "gone", 0, "2"), (1, "x", 2, "1"), (3, "new", 1, "1")],
                                       "id int, v string, op_code int, time_key string")
    (done,) = world.run(route="SRC2GP")
    assert done.error is None
    assert sorted((r.id, r.v, r.hvr_is_deleted) for r in target.read().collect()) == [
        (1, "gone", 1), (2, "kept", 0), (3, "new", 0)]
    state = {r.data_path: r for r in world.state()}
    assert state["SRC2GP"].last_run_time == T2
    assert state["GP2HDFS"].hvr_last_processed_value == T2
    assert state["GP2HDFS"].last_run_time == T1


def test_partitioned_change_target(world, spark, folder):
    target = TableTarget(spark, "app.things", world.target.root)
    base = spark.sql("select id, 'old' v, 0 gone, timestamp_ntz'2024-01-01 00:00:00' at_ts, "
                     "cast(pmod(id, 4) as int) b from values (1), (2), (3), (5) t(id)")
    target.redefine(base, "start", ["b"])
    schema = spark.createDataFrame([], CT.SCHEMA).schema
    world.control.publish(spark.createDataFrame([control_row(
        spark, data_path="SRC2GP", is_partitioned=True, first_partitioned_column="b",
        partition_column_transformation="cast(pmod(id, 4) as int)")], schema), 50)
    drop_files(spark.createDataFrame([(1, "new", 0, "1"), (2, "x", 5, "1"), (8, "eight", 1, "1")],
                                     "id int, v string, op_code int, time_key string"),
               f"{folder}/in", "things", "b1")
    (done,) = world.run(route="SRC2GP", drops=f"{folder}/in", flag="gone", stamp="at_ts")
    assert done.error is None and done.rows == 3
    assert sorted((r.id, r.v, r.gone, r.b) for r in target.read().collect()) == [
        (1, "new", 1, 1), (3, "old", 0, 3), (5, "old", 0, 1), (8, "eight", 0, 0)]
    assert {r.partition for r in spark.sql("SHOW PARTITIONS app.things").collect()} == {
        "b=0", "b=1", "b=3"}


def test_drops_are_applied_then_archived(world, spark, folder):
    target = TableTarget(spark, "app.things", world.target.root)
    target.redefine(spark.sql("select 1 id, 'old' v, 0 hvr_is_deleted, "
                              "timestamp_ntz'2024-01-01 00:00:00' load_ts"), "start")
    business = T.StructType.fromDDL("id int, v string")
    spec = LoadSpec(1, "SRC2RDS", "INCREMENTAL", "app", "things", "app", "things", keys=("id",))
    how = dict(now=T2, load_id=4, archive_root=f"{folder}/done")
    assert load_drops(spark, spec, f"{folder}/in", business, target, **how) == 0
    drop_files(spark.createDataFrame([(1, "new", 2, "1"), (2, "two", 1, "1")],
                                     "id int, v string, op_code int, time_key string"),
               f"{folder}/in", "things", "b1")
    assert load_drops(spark, spec, f"{folder}/in", business, target, **how) == 2
    assert world.values() == [(1, "new"), (2, "two")]
    assert fs.names(spark, f"{folder}/in") == []
    assert fs.names(spark, f"{folder}/done/app/2024-01-20/things")


def test_file_and_cross_routes(world, spark):
    for i, route in enumerate(("GP2Postgres", "COMM2BUS")):
        TableTarget(spark, "app.things", f"{world.target.root}{i}").redefine(
            spark.createDataFrame([(1, "old", T0, 0), (3, "old", T0, 0)], FIELDS), "start")
        world.target = TableTarget(spark, "app.things", f"{world.target.root}{i}")
        schema = spark.createDataFrame([], CT.SCHEMA).schema
        world.control.publish(spark.createDataFrame([control_row(spark, data_path=route)],
                                                    schema), 50 + 100 * i)
        (done,) = world.run(route=route, load_id=20 + i)
        assert done.error is None
        assert world.values() == [(1, "old"), (3, "three"), (4, "four")]
        assert world.state()[0].last_run_time == T2


def test_other_schema_needs_a_flag():
    spec = LoadSpec(1, "GP2HDFS", "FULL", "a", "t", "b", "t")
    with pytest.raises(ValueError, match="differs from"):
        check_target_schema(spec)
    check_target_schema(spec, special=True)
    with pytest.raises(ValueError, match="unknown route"):
        loader_for("NOWHERE")


def test_configured_select_lists(spark):
    spec = LoadSpec(1, "GP2HDFS", "FULL", "a", "t", "a", "t", partition_by=("y", "m"),
                    partition_expr="year(d) as y, coalesce(month(d), 0)",
                    distribute_by=("b",), distribute_expr="id % 8 as b")
    df = spark.createDataFrame([(9, datetime(2024, 3, 1), "x")], "id int, d timestamp_ntz, m string")
    out = spec.with_layout_columns(df)
    assert out.columns == ["id", "d", "b", "y", "m"]
    assert tuple(out.first())[2:] == (1, 2024, 3)
    with pytest.raises(ValueError, match="does not give 2 columns"):
        LoadSpec(1, "GP2HDFS", "FULL", "a", "t", "a", "t", partition_by=("y", "m"),
                 partition_expr="year(d)").with_layout_columns(df)


def test_full_load_is_validated(world):
    world.save(control_row(world.control.spark, load_type="FULL"))
    (done,) = world.run("FULL", validate=True)
    assert done.error is None and done.rows == 5


def _cli(world, folder, *more):
    return main(["--control", world.control.root, "--audit", world.audit_path, "--schema", "app",
                 "--load-id", "9", "--now", "2024-01-20 00:00:00", "--warehouse", f"{folder}/wh",
                 *more], spark=world.control.spark)


def test_command_line_mirror(world, spark, folder, capsys):
    spark.sql("CREATE DATABASE IF NOT EXISTS src")
    world.rows.createOrReplaceTempView("things_rows")
    spark.sql("DROP VIEW IF EXISTS src.things")
    spark.sql("DROP TABLE IF EXISTS src.things")
    world.rows.write.mode("overwrite").orc(f"{folder}/src")
    spark.sql(f"CREATE TABLE src.things USING ORC LOCATION '{folder}/src'")
    world.save(control_row(spark, data_path="MIR2HIVE", source_schemaname="src", load_type="FULL"))
    args = ["--route", "MIR2HIVE", "--load-type", "FULL"]
    assert _cli(world, folder, *args) == 0
    assert len(world.values()) == 5
    assert _cli(world, folder, *args, "--tables", "others") == 0
    out = capsys.readouterr().out
    assert "app.things: 5 rows" in out and "no FULL MIR2HIVE tables to load" in out
    spark.sql("DROP TABLE src.things")


def test_command_line_drops(world, spark, folder, capsys):
    TableTarget(spark, "app.things", f"{folder}/wh/app/things").redefine(
        spark.sql("select 1 id, 'old' v, 0 hvr_is_deleted, "
                  "timestamp_ntz'2024-01-01 00:00:00' load_ts"), "start")
    world.save(control_row(spark, data_path="SRC2GP"))
    drop_files(spark.createDataFrame([(1, "new", 2, "1"), (2, "two", 1, "1")],
                                     "id int, v string, op_code int, time_key string"),
               f"{folder}/in", "things", "b1")
    args = ["--route", "SRC2GP", "--load-type", "INCREMENTAL", "--drops", f"{folder}/in",
            "--archive", f"{folder}/done"]
    assert _cli(world, folder, *args) == 0
    assert world.values() == [(1, "new"), (2, "two")]
    with open(f"{folder}/in/2-things.csv", "w") as f:
        f.write("1|broken\n")
    assert _cli(world, folder, *args) == 1
    assert "failed: app.things" in capsys.readouterr().out
    assert fs.names(spark, f"{folder}/in") == ["2-things.csv"]
    assert world.values() == [(1, "new"), (2, "two")]


def test_lost_table_is_not_replaced(world):
    """A keyed or append load never turns into a replacement of states that are there."""
    spark = world.control.spark
    _seed(world, [(k, "old", T0, 0) for k in range(10, 30)])
    spark.sql("DROP TABLE app.things")
    schema = spark.createDataFrame([], CT.SCHEMA).schema
    for version, kind in ((50, "INCREMENTAL"), (60, "APPEND_ONLY")):
        world.control.publish(spark.createDataFrame([control_row(spark, load_type=kind)], schema),
                              version)
        (done,) = world.run(kind, load_id=version)
        assert "is not in the catalog" in done.error
    assert fs.names(spark, world.target.root) == ["load1"]
    # a full load may replace it, and removes nothing it doesn't know
    world.control.publish(spark.createDataFrame([control_row(spark, load_type="FULL")], schema), 70)
    (done,) = world.run("FULL", load_id=70)
    assert done.error is None
    assert fs.names(spark, world.target.root) == ["load1", "load70"]


def test_definition_cut_short_is_finished(world):
    spark = world.control.spark
    _seed(world, [(1, "old", T0, 0)])
    spark.sql("ALTER TABLE app.things RENAME TO app.things__next")  # lost between the steps
    assert world.target.exists()
    assert world.values() == [(1, "old")]


def test_repeated_append_adds_its_rows_once(world):
    spark = world.control.spark
    _seed(world, [(1, "old", T0, 0)])
    schema = spark.createDataFrame([], CT.SCHEMA).schema
    for version in (50, 60):  # the watermark didn't move in between
        world.control.publish(
            spark.createDataFrame([control_row(spark, load_type="APPEND_ONLY")], schema), version)
        (done,) = world.run("APPEND_ONLY", load_id=9)
        assert done.error is None
    assert world.values() == [(1, "old"), (3, "three")]


def test_in_memory_catalog_is_refused(spark):
    from tidemark.plans.cli import require_lasting_catalog
    with pytest.raises(ValueError, match="catalog that outlives"):
        require_lasting_catalog(spark)


def test_partitioned_change_apply_follows_moved_keys(spark, folder):
    from tidemark.plans.sync import load_changes
    spark.sql("CREATE DATABASE IF NOT EXISTS app")
    spark.sql("DROP TABLE IF EXISTS app.moved")
    target = TableTarget(spark, "app.moved", f"{folder}/moved")
    rows = spark.createDataFrame([(1, 2023, 0, None), (2, 2023, 0, None), (3, 2022, 0, None)],
                                 "id int, y int, hvr_is_deleted int, load_ts timestamp_ntz")
    target.redefine(rows.select("id", "hvr_is_deleted", "load_ts", "y"), "load1", ["y"])
    spec = LoadSpec(id=1, route=CT.CHANGES_TO_DB, load_type="INCREMENTAL", source_schema="app",
                    source_table="moved", target_schema="app", target_table="moved", keys=("id",),
                    partition_by=("y",))
    changes = spark.createDataFrame([(1, 2024, 2, "5"), (3, 2024, 5, "5")],
                                    "id int, y int, op_code int, time_key string")
    load_changes(spark, spec, changes, target, now=T2, load_id=5)
    spark.catalog.refreshTable("app.moved")
    assert sorted((r.id, r.y) for r in target.read().collect()) == [(1, 2024), (2, 2023)]
    spark.sql("DROP TABLE app.moved")


def test_loads_side_by_side_keep_every_status(spark, folder):
    spark.sql("CREATE DATABASE IF NOT EXISTS app")
    control = Versions(spark, f"{folder}/control")
    schema = spark.createDataFrame([], CT.SCHEMA).schema
    names = [f"side{k}" for k in range(5)]
    control.publish(spark.createDataFrame(
        [control_row(spark, id=k, source_tablename=n, target_tablename=n, load_type="FULL")
         for k, n in enumerate(names)], schema), 1)
    source = spark.createDataFrame([(1, "one", T0, 0)], FIELDS)

    def source_of(spec):
        if spec.source_table == "side3":
            raise RuntimeError("first line\nsecond line")
        return source
    done = run_due(spark, control, f"{folder}/audit", route="GP2HDFS", schema="app",
                   load_type="FULL", now=T2, load_id=4, at_once=3, source_of=source_of,
                   target_of=lambda s: TableTarget(spark, f"app.{s.target_table}",
                                                   f"{folder}/wh/{s.target_table}"))
    assert sorted(o.spec.target_table for o in done) == names
    assert {r.target_tablename: r.load_status_cd for r in control.read(schema).collect()} == {
        n: "E" if n == "side3" else "C" for n in names}
    (failed,) = audit.read(spark, f"{folder}/audit").filter("status = 'Job Error'").collect()
    assert failed.error_message == "first line\nsecond line"
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS app.{n}")


def test_audit_counts_are_those_of_the_target(world):
    spark = world.control.spark
    _seed(world, [(1, "old", T0, 0), (2, "old", T0, 0), (9, "kept", T0, 0)])
    schema = spark.createDataFrame([], CT.SCHEMA).schema
    world.control.publish(spark.createDataFrame([control_row(spark)], schema), 50)
    (done,) = world.run()                              # ids 2, 3, 4 come in
    assert done.error is None
    rows = {r.load_id: r for r in audit.read(spark, world.audit_path).collect()}
    names = ("source_row_count", "rows_inserted", "rows_updated", "rows_deleted",
             "target_row_count")
    assert [rows[1][n] for n in names] == [3, 3, 0, 0, 3]
    assert [rows[7][n] for n in names] == [3, 3, 1, 1, 5]
    assert len(world.values()) == 5


def test_change_counts_and_drift(spark, folder):
    from tidemark.plans.sync import load_changes
    spark.sql("CREATE DATABASE IF NOT EXISTS app")
    spark.sql("DROP TABLE IF EXISTS app.counted")
    target = TableTarget(spark, "app.counted", f"{folder}/counted")
    fields = "id int, v string, hvr_is_deleted int, load_ts timestamp_ntz"
    target.redefine(spark.createDataFrame([(1, "a", 0, T0), (2, "b", 0, T0), (None, "n", 0, T0),
                                           (4, "d", 0, T0)], fields), "load1")
    spec = LoadSpec(id=1, route=CT.CHANGES_TO_DB, load_type="INCREMENTAL", source_schema="app",
                    source_table="counted", target_schema="app", target_table="counted",
                    keys=("id",))
    changes = spark.createDataFrame(
        [(1, "x", 2, "5"), (1, "y", 2, "6"), (2, "b", 5, "5"), (None, "m", 2, "5"),
         (7, "new", 1, "5")], "id int, v string, op_code int, time_key string")
    counts = {}
    assert load_changes(spark, spec, changes, target, now=T2, load_id=5, counts=counts) == 5
    assert counts == {"rows_inserted": 3, "rows_updated": 2, "rows_deleted": 3,
                      "target_row_count": 4}
    spark.catalog.refreshTable("app.counted")
    assert target.read().count() == 4
    with pytest.raises(ValueError, match="drifted: new .'w'., missing .'v'."):
        load_changes(spark, spec, changes.withColumnRenamed("v", "w"), target, now=T2, load_id=6)
    spark.sql("DROP TABLE app.counted")
