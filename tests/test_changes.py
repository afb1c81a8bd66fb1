"""Change-log semantics on hand-written rows."""

import random
from datetime import datetime

import pytest

from tidemark.operators.changes import (apply_changes, latest_changes, reduced_changes,
                                        refuse_older)
from tidemark.operators.keyed import delete_matching, latest_per_key

TS = "2024-02-01 00:00:00"
T0 = datetime(2024, 1, 1)
T1 = datetime(2024, 2, 1)
TARGET = "k1 string, k2 int, v string, hvr_is_deleted int, load_ts timestamp_ntz"
CHANGE = "k1 string, k2 int, v string, op_code int, time_key string"
KEYS = ["k1", "k2"]


def target(spark, *rows):
    return spark.createDataFrame([(*r, 0, T0) for r in rows], TARGET)


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), CHANGE)


def got(df):
    return sorted(((r.k1, r.k2, r.v, r.hvr_is_deleted, r.load_ts == T1) for r in df.collect()),
                  key=repr)


def want(*rows):
    return sorted(rows, key=repr)


def test_newest_change_wins_and_delete_sets_flag(spark):
    out = apply_changes(target(spark, ("a", 1, "old"), ("b", 1, "old"), ("c", 1, "kept")),
                        changes(spark, ("a", 1, "x", 1, "01"), ("a", 1, "y", 2, "02"),
                                ("b", 1, "gone", 0, "05"), ("b", 1, "x", 2, "04")),
                        KEYS, load_ts=TS)
    assert got(out) == want(("a", 1, "y", 0, True), ("b", 1, "gone", 1, True),
                            ("c", 1, "kept", 0, False))


def test_deleted_then_inserted_again(spark):
    out = apply_changes(target(spark, ("a", 1, "old")),
                        changes(spark, ("a", 1, "x", 0, "01"), ("a", 1, "y", 1, "02")),
                        KEYS, load_ts=TS)
    assert got(out) == want(("a", 1, "y", 0, True))


def test_order_key_compares_as_text(spark):
    out = latest_changes(changes(spark, ("a", 1, "nine", 2, "9"), ("a", 1, "ten", 2, "10")), KEYS)
    assert [r.v for r in out.collect()] == ["nine"]


def test_null_order_key_is_newest(spark):
    out = latest_changes(changes(spark, ("a", 1, "late", 2, "99"), ("a", 1, "null", 2, None)), KEYS)
    assert [r.v for r in out.collect()] == ["null"]


def test_ties_are_settled_by_other_columns(spark):
    rows = [("a", 1, v, 2, "07") for v in "pqrst"]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        out = latest_changes(changes(spark, *rows).repartition(3), KEYS)
        assert [r.v for r in out.collect()] == ["t"]


def test_key_with_only_ignored_op_is_removed(spark):
    out = apply_changes(target(spark, ("a", 1, "old"), ("b", 1, "old")),
                        changes(spark, ("a", 1, "x", 5, "01"), ("b", 1, "y", 2, "01"),
                                ("b", 1, "z", 5, "02")), KEYS, load_ts=TS)
    assert got(out) == want(("b", 1, "y", 0, True))


def test_null_op_code_deletes_but_is_not_inserted(spark):
    out = apply_changes(target(spark, ("a", 1, "old")),
                        changes(spark, ("a", 1, "x", None, "01")), KEYS, load_ts=TS)
    assert got(out) == []


def test_null_keys_match_null_safe_only(spark):
    old = target(spark, ("a", None, "old"), (None, None, "old"))
    new = changes(spark, ("a", None, "new", 2, "01"))
    assert got(apply_changes(old, new, KEYS, load_ts=TS)) == want(
        ("a", None, "new", 0, True), (None, None, "old", 0, False))
    assert got(apply_changes(old, new, KEYS, load_ts=TS, null_safe=False)) == want(
        ("a", None, "new", 0, True), ("a", None, "old", 0, False), (None, None, "old", 0, False))


def test_sentinel_like_key_is_not_null(spark):
    old = spark.createDataFrame([("99999999999999999", "old"), (None, "null")], "k string, v string")
    new = spark.createDataFrame([(None,)], "k string")
    out = delete_matching(old, new, ["k"], null_safe=True)
    assert [r.v for r in out.collect()] == ["old"]


def test_append_only_deletes_then_inserts_every_op_one(spark):
    old = target(spark, ("a", 1, "old"), ("b", 1, "old"))
    new = changes(spark, ("a", 1, "x", 1, "01"), ("a", 1, "y", 1, "02"), ("b", 1, "z", 2, "01"))
    out = apply_changes(old, new, KEYS, load_ts=TS, load_type="APPEND_ONLY")
    assert got(out) == want(("a", 1, "x", 0, True), ("a", 1, "y", 0, True))
    strict = apply_changes(old, new, KEYS, load_ts=TS, load_type="APPEND_ONLY", null_safe=False)
    assert got(strict) == want(("a", 1, "y", 0, True), ("b", 1, "z", 0, True))


def test_full_ignores_old_rows(spark):
    out = apply_changes(target(spark, ("a", 1, "old")), changes(spark, ("b", 1, "x", 1, "1")),
                        KEYS, load_ts=TS, load_type="FULL")
    assert got(out) == want(("b", 1, "x", 0, True))


def test_delete_by_other_columns(spark):
    out = apply_changes(target(spark, ("a", 1, "old"), ("a", 2, "old"), ("b", 3, "old")),
                        changes(spark, ("a", 1, "x", 2, "01")), KEYS, load_ts=TS,
                        delete_keys=["k1"])
    assert got(out) == want(("a", 1, "x", 0, True), ("b", 3, "old", 0, False))


def test_empty_change_set_keeps_target(spark):
    old = target(spark, ("a", 1, "old"), (None, None, "old"))
    assert got(apply_changes(old, changes(spark), KEYS, load_ts=TS)) == got(old)


def test_unknown_load_type(spark):
    with pytest.raises(ValueError, match="load type"):
        apply_changes(target(spark), changes(spark), KEYS, load_ts=TS, load_type="UPSERT")


def test_applying_a_batch_twice_is_applying_it_once(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abcd") if rng.random() > .1 else None, rng.randrange(4), str(i),
             rng.choice([0, 1, 2, 5]), f"{rng.randrange(50):03d}") for i in range(120)]
    old = target(spark, *[(k, n, "old") for k in "abcdef" for n in range(4)], (None, 1, "old"))
    once = apply_changes(old, changes(spark, *rows), KEYS, load_ts=TS)
    twice = apply_changes(once, changes(spark, *rows), KEYS, load_ts=TS)
    assert got(once) == got(twice)


def test_batches_in_order_equal_one_batch(spark):
    rng = random.Random(11)
    rows = [(rng.choice("abcd"), rng.randrange(4), str(i), rng.choice([0, 1, 2]), f"{i:04d}")
            for i in range(90)]
    old = target(spark, *[(k, n, "old") for k in "abcdef" for n in range(4)])
    step = old
    for lo in range(0, 90, 30):
        step = apply_changes(step, changes(spark, *rows[lo:lo + 30]), KEYS, load_ts=TS)
    assert got(step) == got(apply_changes(old, changes(spark, *rows), KEYS, load_ts=TS))


def test_brute_force(spark):
    rng = random.Random(3)
    for _ in range(3):
        rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), str(i),
                 rng.choice([0, 1, 2, 5, None]), rng.choice([None, "1", "2", "10"]))
                for i in range(40)]
        old_rows = [(k, n, "old") for k in ("a", "b", "z", None) for n in (1, 2, None)]
        hit = {(r[0], r[1]) for r in rows}
        expect = [(k, n, v, 0, False) for k, n, v in old_rows if (k, n) not in hit]
        for key in hit:
            mine = [r for r in rows if (r[0], r[1]) == key and r[3] not in (5, None)]
            if mine:
                best = max(mine, key=lambda r: (r[4] is None, r[4] or "", r[2], r[3]))
                expect.append((*best[:3], int(best[3] == 0), True))
        out = apply_changes(target(spark, *old_rows), changes(spark, *rows), KEYS, load_ts=TS)
        assert got(out) == want(*expect)


@pytest.mark.parametrize("how", [
    {}, {"null_safe": False}, {"load_type": "FULL"}, {"load_type": "APPEND_ONLY"},
    {"load_type": "APPEND_ONLY", "null_safe": False}, {"delete_keys": ["k1"]},
    {"delete_keys": ["v"], "null_safe": False}])
def test_reduced_changes_apply_alike(spark, how):
    rng = random.Random(17)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([1, 2, None]), rng.choice("pqrs"),
             rng.choice([0, 1, 2, 5, None]), rng.choice([None, "1", "2", "10"]))
            for _ in range(60)]
    old = target(spark, *[(k, n, v) for k in ("a", "c", "z", None) for n in (1, 2, None)
                          for v in "ps"])
    log = changes(spark, *rows)
    fewer = reduced_changes(log, KEYS, **how)
    assert got(apply_changes(old, fewer, KEYS, load_ts=TS, **how)) == got(
        apply_changes(old, log, KEYS, load_ts=TS, **how))
    if not how:
        assert fewer.count() == len({r[:2] for r in rows})


def test_refuse_older_keeps_newest(spark):
    held = spark.createDataFrame([("a", 1, "old", "05", 0, T0), ("b", 1, "old", "05", 0, T0)],
                                 "k1 string, k2 int, v string, time_key string, "
                                 "hvr_is_deleted int, load_ts timestamp_ntz")
    batch = changes(spark, ("a", 1, "stale", 2, "03"), ("b", 1, "fresh", 2, "07"))
    assert [r.v for r in refuse_older(batch, held, KEYS).collect()] == ["fresh"]
    out = apply_changes(held, batch, KEYS, load_ts=TS, keep_newest=True)
    assert sorted((r.k1, r.v, r.time_key) for r in out.collect()) == [
        ("a", "old", "05"), ("b", "fresh", "07")]


def test_latest_per_key_typed_order(spark):
    df = spark.createDataFrame([("a", 9), ("a", 10)], "k string, n int")
    assert [r.n for r in latest_per_key(df, ["k"], "n").collect()] == [10]
