"""Text and change files: escapes, NULL and empty, malformed rows."""

import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text as X
from tidemark.sinks.publish import drop_files
from tidemark.sinks.text import write_soh, write_sub, write_text
from tidemark.sources.changes_csv import find_drops, read_changes
from tidemark.sources.text import parse_lines, read_soh, read_sub, read_text

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("a", T.StringType()),
                       T.StructField("b", T.StringType())])
HOSTILE = ["\\", "\\\\", "\\N", "\\n", "\n", "\r", "\r\n", "\x01", "\x1a", "\\\x01", "\\\\\x1a",
           "\t\b\f\v", "a\\", "\\a", " lead and trail ", '"q"', "|", "ünï€𝄞", "\\\\\\\x01\\n", "null"]


def pairs(df):
    return sorted(((r.id, r.a, r.b) for r in df.collect()), key=repr)


def test_soh_round_trip_is_exact(spark, folder):
    rows = [(i, h, HOSTILE[-i]) for i, h in enumerate(HOSTILE)] + [(90, None, ""), (91, "", None),
                                                                    (None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    write_soh(df, f"{folder}/t")
    assert pairs(read_soh(spark, f"{folder}/t", SCHEMA)) == sorted(rows, key=repr)


def test_sub_round_trip_reads_empty_as_null(spark, folder):
    rows = [(i, h, "x") for i, h in enumerate(HOSTILE)] + [(90, None, ""), (91, "", None)]
    write_sub(spark.createDataFrame(rows, SCHEMA), f"{folder}/t")
    expect = [(i, a or None, b or None) for i, a, b in rows]
    assert pairs(read_sub(spark, f"{folder}/t", SCHEMA)) == sorted(expect, key=repr)


@pytest.mark.parametrize("sep", ["|", ",", "$", "^"])
def test_printable_separator(spark, folder, sep):
    rows = [(1, f"a{sep}b", sep), (-2, f"\\{sep}", None)]
    write_text(spark.createDataFrame(rows, SCHEMA), f"{folder}/t", sep=sep, null_value="\\N")
    out = read_text(spark, f"{folder}/t", SCHEMA, sep=sep, null_value="\\N")
    assert pairs(out) == sorted(rows, key=repr)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text(alphabet="\\\x01nrN\n\r\tab", max_size=12),
                          st.none() | st.text(alphabet="\\\x01bfv", max_size=6)),
                min_size=1, max_size=20))
def test_any_text_survives(spark, values):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(values)], SCHEMA)
    lines = df.select(X.join_fields(SCHEMA, X.SOH, X.NULL_MARK, X.COPY_ESCAPES).alias("value"))
    assert not [r for r in lines.collect() if "\n" in r.value]
    out = parse_lines(lines, SCHEMA, X.SOH, X.NULL_MARK, X.COPY_ESCAPES)
    assert pairs(out) == pairs(df)


def test_nul_character_is_refused(spark):
    df = spark.createDataFrame([(1, "a\x00b", "c")], SCHEMA)
    with pytest.raises(Exception, match=r"U\+0000"):
        df.select(X.join_fields(SCHEMA, X.SOH, X.NULL_MARK)).collect()


def test_wrong_field_count_fails_or_pads(spark):
    lines = spark.createDataFrame([("1\x01a",), ("2\x01a\x01b\x01c",)], "value string")
    with pytest.raises(Exception, match="expected 3 fields"):
        parse_lines(lines, SCHEMA, X.SOH, X.NULL_MARK).collect()
    with pytest.raises(Exception, match="expected 3 fields, got 4"):
        parse_lines(lines, SCHEMA, X.SOH, X.NULL_MARK, on_bad_row="pad").collect()
    out = parse_lines(lines.filter("value like '1%'"), SCHEMA, X.SOH, X.NULL_MARK, on_bad_row="pad")
    assert pairs(out) == [(1, "a", None)]


def test_unreadable_number_fails(spark):
    lines = spark.createDataFrame([("x1\x01a\x01b",)], "value string")
    with pytest.raises(Exception, match="column id: cannot read as int: x1"):
        parse_lines(lines, SCHEMA, X.SOH, X.NULL_MARK).collect()


def _drop(folder, text, name="1-things.csv"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_csv_null_empty_and_escapes(spark, folder):
    _drop(folder, '1|\\N||1|k1\n2|"a|b"|"say \\"hi\\""|2|k2\n\\N|back\\slash|" x "|0|\\N\n')
    out = read_changes(spark, folder, "things", SCHEMA)
    got = sorted([tuple(r) for r in out.collect()], key=repr)
    assert got == sorted([(1, None, "", 1, "k1"), (2, "a|b", 'say "hi"', 2, "k2"),
                          (None, "back\\slash", " x ", 0, None)], key=repr)


@pytest.mark.parametrize("bad", ["1|a|b|1\n", "1|a|b|1|k|more\n", "|a|b|1|k\n", "1|a|b|one|k\n"])
def test_csv_bad_rows_fail(spark, folder, bad):
    _drop(folder, "1|a|b|1|k\n" + bad)
    out = read_changes(spark, folder, "things", SCHEMA)
    with pytest.raises(Exception, match="malformed change row|cannot read as"):
        out.collect()


def test_csv_short_row_fails_even_when_few_columns_are_read(spark, folder):
    _drop(folder, "1|a|b|1|k\n2|a\n")
    with pytest.raises(Exception, match="malformed change row"):
        read_changes(spark, folder, "things", SCHEMA).select("a").collect()


def test_csv_line_breaks_in_quotes(spark, folder):
    _drop(folder, '1|"two\nlines"|b|1|k\n')
    out = read_changes(spark, folder, "things", SCHEMA, multi_line=True)
    assert [r.a for r in out.collect()] == ["two\nlines"]


def test_drops_are_found_by_table(spark, folder):
    _drop(folder, "1|a|b|1|k\n", "1-things.csv")
    _drop(folder, "1|a|b|1|k\n", "1-others.csv")
    assert [f.rsplit("/", 1)[-1] for f in find_drops(spark, folder, "things")] == ["1-things.csv"]
    assert find_drops(spark, folder, "absent") == []
    assert read_changes(spark, folder, "absent", SCHEMA).count() == 0


def test_drop_files_round_trip(spark, folder):
    rows = [(1, "a|b", ""), (2, None, '"'), (3, " s ", "\\")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 op_code", "'t' time_key")
    files = drop_files(df.repartition(2), f"{folder}/in", "things", "b1")
    assert files and all(f.endswith("-things.csv") for f in files)
    out = read_changes(spark, f"{folder}/in", "things", SCHEMA)
    assert pairs(out) == sorted(rows, key=repr)
    assert out.filter(F.col("op_code") != 1).count() == 0
