"""The control table as an event log: concurrent runs, folding, cut-short steps."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.test_control import control
from tests.test_sync import FIELDS, T0, T1, T2, control_row
from tidemark import fs
from tidemark.control import events as CE
from tidemark.control import table as CT
from tidemark.plans.sync import run_due
from tidemark.sinks.targets import TableTarget


@pytest.fixture
def log(spark, folder):
    log = CE.ControlLog(spark, f"{folder}/control")
    log.publish(control(spark, dict(id=1, target_tablename="a", last_run_time=T0),
                        dict(id=2, target_tablename="b", last_run_time=T0),
                        dict(id=3, target_tablename="b", data_path="HDFS2MIR")), 1)
    return log


def state(log):
    return {r.id: r for r in log.read().collect()}


def advance(table, end):
    return lambda rows: CT.advance(rows, "m", table, "HDFS2MIR", end)


def test_put_new_only_once(spark, folder):
    path = f"{folder}/sub/x.json"
    assert fs.put_new(spark, path, "one\n")
    assert not fs.put_new(spark, path, "two\n")
    assert open(path).read() == "one\n"
    assert fs.names(spark, f"{folder}/sub") == ["x.json"]


def test_updates_are_events(log):
    assert log.update(advance("a", T1)) == 2
    assert log.update(advance("b", T2)) == 3
    assert log.update(lambda rows: rows) is None
    rows = state(log)
    assert (rows[1].last_run_time, rows[1].second_last_run_time) == (T1, T0)
    assert (rows[2].last_run_time, rows[3].last_run_time) == (T2, T2)
    assert rows[3].second_last_run_time is None and rows[3].load_status_cd == "C"
    assert log.base.complete() == [1]


def test_null_and_microseconds_survive(log):
    moment = datetime(2024, 3, 1, 1, 2, 3, 456789)
    log.update(advance("a", moment))
    log.update(lambda rows: rows.withColumn("second_last_run_time", F.lit(None).cast("timestamp_ntz")))
    rows = state(log)
    assert rows[1].last_run_time == moment and rows[1].second_last_run_time is None


def test_an_update_on_an_old_state_is_worked_out_again(log, monkeypatch):
    """Between reading the state and writing its event another run advances the same row."""
    other = CE.ControlLog(log.spark, log.base.root)
    real, started, taken = CE.differences, [], []

    def late(*args):
        found = real(*args)
        if not started:
            started.append(True)
            taken.append(other.update(advance("a", T1)))
        return found

    monkeypatch.setattr(CE, "differences", late)
    # the first try reads last_run_time T0, but its number is gone when it writes
    assert log.update(advance("a", T2)) == 3
    row = state(log)[1]
    assert taken == [2]
    assert (row.last_run_time, row.second_last_run_time) == (T2, T1)


def test_many_writers_keep_every_update(spark, folder):
    log = CE.ControlLog(spark, f"{folder}/control", fold_after=4)
    log.publish(control(spark, *[dict(id=k, target_tablename=f"t{k}") for k in range(10)]), 1)
    logs = [CE.ControlLog(spark, f"{folder}/control", fold_after=4) for _ in range(10)]
    with ThreadPoolExecutor(5) as pool:
        list(pool.map(lambda k: logs[k].update(advance(f"t{k}", T1)), range(10)))
    assert {r.id: r.last_run_time for r in log.read().collect()} == dict.fromkeys(range(10), T1)
    assert len(log.base.complete()) > 1


def test_fold_keeps_the_state_and_removes_old_events(log):
    for day in range(2, 9):
        log.update(advance("a", datetime(2024, 1, day)))
        if day % 2:
            log.fold(keep=2)
    before = state(log)
    assert log.fold(keep=2) == 8 and state(log) == before
    assert log.fold() is None                   # nothing since
    assert len(log.base.complete()) == 2
    assert all(n > log.base.complete()[0] for n in log._numbers())
    assert log.update(advance("b", T2)) == 9


def test_fold_cut_short_leaves_the_state(log, monkeypatch):
    log.update(advance("a", T1))
    before = state(log)
    with monkeypatch.context() as patch:
        def lost(*_):
            raise RuntimeError("lost")
        patch.setattr(log, "publish", lost)
        with pytest.raises(RuntimeError):
            log.fold()
    assert state(log) == before
    assert log.fold() is None                   # its number is claimed
    log.update(advance("b", T2))
    after = state(log)
    assert log.fold() == 3 and state(log) == after


def test_two_interleaved_runs_keep_both_updates(spark, folder):
    spark.sql("CREATE DATABASE IF NOT EXISTS app")
    tables = ["ev_a", "ev_b"]
    for name in tables:
        spark.sql(f"DROP TABLE IF EXISTS app.{name}")
    log = CE.ControlLog(spark, f"{folder}/control")
    schema = log.schema
    log.publish(spark.createDataFrame(
        [control_row(spark, id=k, load_group_id=k, load_type="FULL", source_tablename=name,
                     target_tablename=name) for k, name in enumerate(tables)], schema), 1)
    rows = spark.createDataFrame([(1, "one", T0, 0)], FIELDS)

    def run(group, source_of):
        return run_due(spark, CE.ControlLog(spark, f"{folder}/control"), f"{folder}/audit",
                       route="GP2HDFS", schema="app", load_type="FULL", now=T2, load_id=10 + group,
                       source_of=source_of, group=group, target_of=lambda spec: TableTarget(
                           spark, f"app.{spec.target_table}", f"{folder}/{spec.target_table}"))

    inner = []

    def source_of(spec):
        """While the first run is loading, a second one starts and ends."""
        inner.extend(run(1, lambda _: rows))
        return rows

    (outer,) = run(0, source_of)
    assert outer.error is None and inner[0].error is None
    got = {r.id: (r.load_status_cd, r.last_run_time, r.second_last_run_time)
           for r in log.read().collect()}
    assert got == {0: ("C", T2, T1), 1: ("C", T2, T1)}
    for name in tables:
        spark.sql(f"DROP TABLE IF EXISTS app.{name}")
