"""Control rows, audit log, type map, drift."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.control import audit as A
from tidemark.control import table as CT
from tidemark.functions import types as TY
from tidemark.operators import columns as C
from tidemark.operators.extract import extract, window_filter

T0, T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 10), datetime(2024, 1, 20)
MD = ("column_name string, data_type string, numeric_precision int, numeric_scale int, "
      "ordinal_position int, table_schema string, table_name string")


def control(spark, *rows):
    schema = spark.createDataFrame([], CT.SCHEMA).schema
    base = dict(source_schemaname="s", source_tablename="t", target_schemaname="m",
                target_tablename="t", data_path="GP2HDFS", load_type="FULL", status_flag="Y",
                load_group_id=1)
    return spark.createDataFrame([tuple({**base, **r}.get(n) for n in schema.names) for r in rows],
                                 schema)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_due(spark):
    rows = control(spark, dict(id=1, last_run_time=T0, hvr_last_processed_value=T1),
                   dict(id=2, last_run_time=T1, hvr_last_processed_value=T0), dict(id=3),
                   dict(id=4, status_flag="N"), dict(id=5, load_group_id=2),
                   dict(id=6, data_path="MIR2HIVE"), dict(id=7, data_path="SRC2GP"),
                   dict(id=8, source_tablename="u"))
    assert ids(CT.due(rows, "GP2HDFS", "s", "FULL")) == [1, 3, 5, 8]
    assert ids(CT.due(rows, "GP2HDFS", "s", "FULL", group=2)) == [5]
    assert ids(CT.due(rows, "GP2HDFS", "s", "FULL", tables=["u"])) == [8]
    assert ids(CT.due(rows, "MIR2HIVE", "m", "FULL")) == [6]
    assert ids(CT.due(rows, "MIR2HIVE", "s", "FULL")) == []
    assert ids(CT.due(rows, "SRC2GP", "s", "FULL", tables=["t"])) == [7]


def test_advance_covers_the_paired_rows(spark):
    rows = control(spark, dict(id=1, last_run_time=T0, second_last_run_time=None),
                   dict(id=2, data_path="HDFS2MIR", target_tablename="t_ext", last_run_time=T1),
                   dict(id=3, target_tablename="other", last_run_time=T0))
    out = {r.id: r for r in CT.advance(rows, "m", "t", "HDFS2MIR", T2).collect()}
    assert (out[1].last_run_time, out[1].second_last_run_time, out[1].load_status_cd) == (T2, T0, "C")
    assert (out[2].last_run_time, out[2].second_last_run_time) == (T2, T1)
    assert (out[3].last_run_time, out[3].load_status_cd) == (T0, None)


def test_strict_route_marks_its_own_row(spark):
    rows = control(spark, dict(id=1, data_path="SRC2RDS"), dict(id=2))
    out = {r.id: r for r in CT.changes_applied(rows, "s", "t", "SRC2RDS", T2).collect()}
    assert (out[1].last_run_time, out[1].hvr_last_processed_value) == (T2, T2)
    assert out[2].hvr_last_processed_value is None


def test_audit_log_appends_and_lists_failures(spark, folder):
    A.append_event(spark, folder + "/log", load_id=1, table_name="b", status=A.JOB_ERROR,
                   error_category="it's \"bad\"")
    A.append_event(spark, folder + "/log", load_id=1, table_name="a", status=A.JOB_ERROR)
    A.append_event(spark, folder + "/log", load_id=1, table_name="a", status=A.JOB_ERROR)
    A.append_event(spark, folder + "/log", load_id=2, table_name="c", status=A.JOB_FINISHED)
    log = A.read(spark, folder + "/log")
    assert log.schema == A.SCHEMA and log.count() == 4
    assert [tuple(r) for r in A.failed_tables(log).collect()] == [(1, "a,b", 2)]
    assert log.filter("error_category = 'its bad'").count() == 1


METADATA = [
    ("whole", "numeric", 10, 0, 1), ("cents", "numeric", 12, 2, 2), ("free", "numeric", None, None, 3),
    ("dbl", "double precision", 53, None, 4), ("b$ad", "character varying", None, None, 5),
    ("ts", "timestamp without time zone", None, None, 6), ("arr", "ARRAY", None, None, 7),
    ("flag", "boolean", None, None, 8), ("tz", "timestamp with time zone", None, None, 9),
    ("big", "bigint", 64, 0, 10), ("small", "smallint", 16, 0, 11), ("d", "date", None, None, 12),
    ("wide", "numeric", 50, 0, 13), ("j", "json", None, None, 14)]
COMPAT = ["bigint", "double", "double", "double", "string", "timestamp_ntz", "array<string>",
          "string", "string", "bigint", "smallint", "date", "bigint", "string"]
EXACT = ["decimal(10,0)", "decimal(12,2)", "decimal(38,18)", "double", "string", "timestamp_ntz",
         "array<string>", "boolean", "timestamp", "bigint", "smallint", "date", "decimal(38,18)",
         "string"]


@pytest.mark.parametrize("mode, expect", [(TY.COMPAT, COMPAT), (TY.EXACT, EXACT)])
def test_type_map(spark, mode, expect):
    rows = [(*r, "s", "t") for r in METADATA]
    df = spark.createDataFrame(rows, MD)
    got = TY.map_types(df, mode).orderBy("ordinal_position").collect()
    assert [r.spark_type for r in got] == expect
    assert got[4].target_column == "b_ad"
    schema = TY.struct_type(df.collect(), mode)
    assert [f.dataType.simpleString() for f in schema] == expect
    (line,) = TY.column_lists(df, mode).collect()
    assert line.column_count == 14
    assert line.column_list.startswith(f"`whole` {expect[0]}, `cents` {expect[1]}")


def test_narrowing_counts_overflow(spark):
    df = spark.sql("select cast('99999999999999999999' as decimal(38,0)) n "
                   "union all select cast(5 as decimal(38,0))")
    assert TY.narrowing_overflows(df, {"n": "bigint"}).first().n == 1
    assert sorted(str(r.n) for r in TY.narrow(df, {"n": "bigint"}, on_overflow="null").collect()) == ["5", "None"]


def test_drift(spark):
    a = T.StructType.fromDDL("id int, A string, gone int")
    b = T.StructType.fromDDL("id bigint, a string, fresh int")
    assert TY.drift_between(b, a) == {"added": ["fresh"], "removed": ["gone"], "retyped": ["id"]}


def test_sanitize_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`a$b` int, `c` int")
    assert C.sanitize(df).columns == ["a_b", "c"]
    with pytest.raises(ValueError, match="collide"):
        C.sanitize(df.withColumn("a_b", F.lit(1)))


def test_housekeeping_goes_by_name(spark):
    df = spark.createDataFrame([(0, 1, "x")], "hvr_is_deleted int, id int, time_key string")
    assert C.drop_housekeeping(df).columns == ["id"]


def test_window_is_open_below_and_closed_above(spark):
    df = spark.createDataFrame([(1, T0), (2, T1), (3, T2), (4, None)], "id int, at timestamp_ntz")
    assert ids(window_filter(df, "at", T0, T2)) == [2, 3]
    assert ids(window_filter(df, "at", None, T1)) == [1, 2]
    assert ids(window_filter(df, "at", None, None)) == [1, 2, 3, 4]


def test_first_run_has_no_lower_bound(spark):
    df = spark.createDataFrame([(1, T0, 0), (2, T1, 1)], "id int, at timestamp_ntz, "
                               "hvr_is_deleted int")
    assert ids(extract(df, "INCREMENTAL", "at", now=T2)) == [1, 2]
    assert ids(extract(df, "APPEND_ONLY", "at", now=T2)) == [1]
