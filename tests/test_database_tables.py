"""Definitions of database tables; the statements run in an embedded SQL library."""

import duckdb
import pytest
from pyspark.sql import types as T

from tests.test_control import EXACT, MD, METADATA
from tidemark.functions import types as TY
from tidemark.plans import sync
from tidemark.sinks import jdbc as jdbc_sink
from tidemark.sinks.targets import JdbcTarget


def test_every_mapped_type_has_its_way_back(spark):
    """A source's columns, mapped to Spark and back, have types that hold the same values."""
    columns = spark.createDataFrame([(*r, "s", "t") for r in METADATA], MD).collect()
    schema = TY.struct_type(columns, TY.EXACT)
    assert [f.dataType.simpleString() for f in schema] == EXACT
    back = [TY.database_type(f.dataType) for f in schema]
    assert back == ["numeric(10,0)", "numeric(12,2)", "numeric(38,18)", "double precision", "text",
                    "timestamp without time zone", "text[]", "boolean", "timestamp with time zone",
                    "bigint", "smallint", "date", "numeric(38,18)", "text"]


@pytest.mark.parametrize("ddl, kind", [
    ("tinyint", "smallint"), ("float", "real"), ("binary", "bytea"), ("int", "integer"),
    ("array<decimal(9,2)>", "numeric(9,2)[]"), ("array<timestamp_ntz>",
                                                "timestamp without time zone[]")])
def test_other_types(ddl, kind):
    assert TY.database_type(T.StructType.fromDDL(f"x {ddl}")["x"].dataType) == kind


def test_lengths_of_text_are_kept():
    assert TY.database_type(T.VarcharType(12)) == "character varying(12)"
    assert TY.database_type(T.CharType(3)) == "character(3)"


@pytest.mark.parametrize("ddl", ["map<string,int>", "struct<a:int>", "array<array<int>>",
                                 "interval day to second"])
def test_types_without_a_column_are_refused(ddl):
    schema = T.StructType.fromDDL(f"good int, bad {ddl}")
    with pytest.raises(ValueError, match="column bad"):
        jdbc_sink.create_statement("t", schema)


def test_the_statement_makes_the_table_once():
    schema = T.StructType.fromDDL('id bigint NOT NULL, `odd "name"` string, at timestamp_ntz, '
                                  "price decimal(12,2), tags array<string>")
    text = jdbc_sink.create_statement("t", schema)
    con = duckdb.connect()
    for _ in range(2):              # "already exists" is no error
        con.execute(text)
    con.execute("INSERT INTO t VALUES (1, 'x', TIMESTAMP '2024-01-01', 1.25, ['a'])")
    got = con.execute("SELECT column_name, data_type, is_nullable FROM information_schema.columns "
                      "WHERE table_name = 't' ORDER BY ordinal_position").fetchall()
    assert got == [("id", "BIGINT", "NO"), ('odd "name"', "VARCHAR", "YES"),
                   ("at", "TIMESTAMP", "YES"), ("price", "DECIMAL(12,2)", "YES"),
                   ("tags", "VARCHAR[]", "YES")]


class Link:
    """A connection that knows one table."""

    def __init__(self, schema, name):
        self.known, self.asked, self.closed = (schema, name), [], False

    def getMetaData(self):
        return self

    def getTables(self, catalog, schema, name, kinds):
        self.asked.append((schema, name))
        hit = self.known in ((schema, name), (schema or self.known[0], name))

        class Rows:
            def next(self):
                return hit
        return Rows()

    def close(self):
        self.closed = True


@pytest.mark.parametrize("table, there", [("app.things", True), ("APP.Things", True),
                                          ("things", True), ("app.other", False),
                                          ('"app"."things"', True), ("x.things", False)])
def test_the_target_asks_whether_it_exists(spark, monkeypatch, table, there):
    link = Link("app", "things")
    monkeypatch.setattr(jdbc_sink, "_link", lambda *_: link)
    assert JdbcTarget(spark, "jdbc:x", table).exists() is there
    assert link.closed


def test_a_load_makes_a_missing_table_first(spark):
    calls = []

    class Target:
        table, there = "t", False

        def exists(self):
            return self.there

        def create(self, schema):
            calls.append(("create", schema.simpleString()))
            self.there = True

        def read(self):
            return spark.createDataFrame([], "id int, v string")

        def merge_rows(self, rows, keys, load_type, null_safe, deletes=None):
            calls.append(("merge", rows.count()))
            return [0, rows.count(), 0]

    spec = sync.LoadSpec(id=1, route="COMM2BUS", load_type="INCREMENTAL", source_schema="s",
                         source_table="t", target_schema="s", target_table="t", keys=("id",))
    rows, target = spark.createDataFrame([(1, "a")], "id int, v string"), Target()
    for _ in range(2):
        counts = {}
        sync._upsert(target, spec, rows, "load1", True, counts)
        sync._merge_into(target, spec, rows, "load1", counts)
    assert calls == [("create", "struct<id:int,v:string>"), *[("merge", 1)] * 4]
