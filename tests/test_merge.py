"""Merges, partition-scoped merges and their publication."""

import random

import pytest

from tidemark.operators import merge as M
from tidemark.operators.metrics import (count_validate, merge_metrics, observed, require_counts)
from tidemark.sinks import orc
from tidemark.sinks.publish import replace_partitions
from tidemark.sources.tables import read_orc

S = "k int, v string, p string, q int"


def rows(df):
    return sorted(((r.k, r.v, r.p, r.q) for r in df.collect()), key=repr)


def frame(spark, *data):
    return spark.createDataFrame(list(data), S)


OLD = [(1, "old", "x", 1), (2, "old", "x", 2), (3, "old", "y", 1), (4, "old", "z", 9),
       (None, "old", "x", 1)]


def test_merge_flat_keeps_duplicates_and_null_keys(spark):
    new = frame(spark, (1, "a", "x", 1), (1, "b", "x", 1), (None, "n", "x", 1))
    out = M.merge_flat(frame(spark, *OLD), new, ["k"])
    assert rows(out) == sorted([*OLD[1:], (1, "a", "x", 1), (1, "b", "x", 1),
                                (None, "n", "x", 1)], key=repr)


def test_merge_flat_dedupe(spark):
    new = frame(spark, (1, "a", "x", 1), (1, "b", "x", 2))
    out = M.merge_flat(frame(spark, *OLD), new, ["k"], dedupe="q")
    assert (1, "b", "x", 2) in rows(out) and (1, "a", "x", 1) not in rows(out)


def test_merge_ignores_column_order_and_extra_columns(spark):
    new = frame(spark, (1, "a", "x", 1)).selectExpr("q", "p", "v", "k", "1 as extra")
    assert (1, "a", "x", 1) in rows(M.merge_flat(frame(spark, *OLD), new, ["k"]))
    with pytest.raises(ValueError, match="lacks target columns: v"):
        M.merge_flat(frame(spark, *OLD), new.drop("v"), ["k"])


def test_row_conservation(spark):
    old, new = frame(spark, *OLD), frame(spark, (1, "a", "x", 1), (9, "b", "w", 1))
    m = merge_metrics(old, new, ["k"]).first()
    assert (m.rows_incoming, m.rows_inserted, m.rows_updated, m.rows_kept) == (2, 1, 1, 4)
    assert M.merge_flat(old, new, ["k"]).count() == m.rows_kept + m.rows_incoming


def test_metrics_of_nothing(spark):
    m = merge_metrics(frame(spark), frame(spark), ["k"]).first()
    assert tuple(m) == (0, 0, 0, 0)


@pytest.mark.parametrize("part", [["p"], ["p", "q"]])
def test_partitioned_equals_flat_when_keys_stay(spark, folder, part):
    rng = random.Random(7)
    old = [(k, "old", "xyzw"[k % 4], k % 3) for k in range(40)]
    new = [(k, "new", "xyzw"[k % 4], k % 3) for k in rng.sample(range(60), 12) if k % 4 < 2]
    path = f"{folder}/t"
    orc.write(frame(spark, *old), path, partition_by=part)
    target = spark.read.schema("k int, v string, " + ", ".join(
        f for f in ("p string", "q int") if f[0] not in part) + ("" if len(part) == 2 else ", ")
        + ", ".join(f for f in ("p string", "q int") if f[0] in part)).orc(path)
    incoming = frame(spark, *new)
    merged = M.merge_partitioned(target, incoming, ["k"], part)
    orc.overwrite_partitions(merged, path, part)
    assert rows(read_orc(spark, path)) == rows(M.merge_flat(frame(spark, *old), incoming, ["k"]))


def test_null_partition_value(spark, folder):
    path = f"{folder}/t"
    orc.write(frame(spark, (1, "old", None, 1), (2, "old", "x", 1)), path, partition_by=["p"])
    target = spark.read.schema("k int, v string, q int, p string").orc(path)
    merged = M.merge_partitioned(target, frame(spark, (1, "new", None, 1)), ["k"], ["p"])
    orc.overwrite_partitions(merged, path, ["p"])
    assert rows(read_orc(spark, path)) == [(1, "new", None, 1), (2, "old", "x", 1)]


def test_text_partition_that_looks_like_a_number(spark, folder):
    path = f"{folder}/t"
    df = frame(spark, (1, "old", "007", 1), (2, "old", "7", 1))
    orc.write(df, path, partition_by=["p"])
    schema = df.select("k", "v", "q", "p").schema
    incoming = frame(spark, (1, "new", "007", 1))
    merged = M.merge_partitioned(read_orc(spark, path, schema=schema), incoming, ["k"], ["p"])
    orc.overwrite_partitions(merged, path, ["p"])
    assert rows(read_orc(spark, path, schema=schema)) == [(1, "new", "007", 1),
                                                          (2, "old", "7", 1)]


def test_moved_key_keeps_old_copy_unless_global(spark, folder):
    new = frame(spark, (4, "new", "x", 1))
    for name, merge, expect in (
            ("scoped", M.merge_partitioned, 2), ("global", M.merge_partitioned_global, 1)):
        path = f"{folder}/{name}"
        orc.write(frame(spark, *OLD), path, partition_by=["p"])
        target = read_orc(spark, path)
        merged = merge(target, new, ["k"], ["p"])
        replace_partitions(merged, M.touched_partitions(target, new, ["k"], ["p"])
                           if name == "global" else M.affected_partitions(new, ["p"]),
                           path, ["p"], may_empty=True)
        assert len([r for r in rows(read_orc(spark, path)) if r[0] == 4]) == expect


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize("new", [
    [], [(2, "n", "x", 1), (3, "n", "x", 1)], [(None, "n", "x", 1)],
    [(None, "n", "x", 1), (4, "n", "x", 1)], [(-5, "n", "x", 1), (99, "n", "x", 1)]])
def test_key_range_changes_nothing_but_the_plan(spark, new, null_safe):
    old, incoming = frame(spark, *OLD), frame(spark, *new)
    assert rows(M.merge_flat(old, incoming, ["k"], null_safe=null_safe, range_key="k")) == rows(
        M.merge_flat(old, incoming, ["k"], null_safe=null_safe))


def test_no_incoming_rows_touch_nothing(spark):
    out = M.merge_partitioned(frame(spark, *OLD), frame(spark), ["k"], ["p"])
    assert rows(out) == []


def test_upsert_full_and_incremental(spark):
    new = frame(spark, (1, "a", "x", 1), (1, "b", "x", 1))
    assert rows(M.upsert_rows(frame(spark, *OLD), new, ["k"], "FULL")) == rows(new)
    assert len(rows(M.upsert_rows(frame(spark, *OLD), new, ["k"], "INCREMENTAL"))) == 6


def test_counts(spark):
    a, b = frame(spark, *OLD), frame(spark, *OLD[:2])
    assert count_validate(a, a).first().counts_match
    assert not count_validate(a, b).first().counts_match
    with pytest.raises(ValueError, match="count mismatch: source 5, target 2"):
        require_counts(a, b)


def test_observed_counts_in_one_pass(spark, folder):
    df, seen = observed(frame(spark, *OLD))
    orc.write(df, f"{folder}/o")
    assert seen.get["rows"] == 5


@pytest.fixture
def new_york(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")


FOLD = ["1699162200000000", "1699165800000000"]  # both read 01:30 when clocks are set back


def _moments(spark, *micros):
    return spark.range(1).selectExpr(f"explode(array({','.join(micros)})) m").selectExpr(
        "timestamp_micros(m) k", "timestamp_micros(m) p", "'v' v")


def test_range_key_in_the_repeated_hour(spark, new_york):
    target, incoming = _moments(spark, *FOLD), _moments(spark, *FOLD)
    kept = M.merge_flat(target, incoming, ["k"], range_key="k")
    assert kept.count() == 2


def test_partition_ranges_in_the_repeated_hour(spark, new_york):
    target = _moments(spark, *FOLD)
    assert M.prune_to(target, target.select("p").distinct(), ["p"]).count() == 2
    late = _moments(spark, FOLD[1])
    assert M.prune_to(target, late.select("p"), ["p"]).count() == 1


def test_binary_range_key(spark):
    rows = [(bytearray(b"\xff\x00"), "a"), (bytearray(b"\x01"), "b")]
    df = spark.createDataFrame(rows, "k binary, v string")
    assert M.merge_flat(df, df, ["k"], range_key="k").count() == 2


def test_prune_to_no_partitions(spark):
    target = spark.createDataFrame([(1, "x")], "k int, p string")
    assert M.prune_to(target, target.select("p").limit(0), ["p"]).count() == 0
