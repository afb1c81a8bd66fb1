"""How the route queries and change loads use the session."""

import random
from datetime import datetime
from threading import Barrier

import pytest

from tests.test_changes import KEYS, TS, changes, got, target
from tidemark import schema as S
from tidemark.operators.changes import apply_changes, reduced_changes
from tidemark.plans import route_queries, sync
from tidemark.plans.sync import AUDITED, LoadSpec, load_changes
from tidemark.sinks.manifest import ManifestTarget
from tidemark.sources.tables import snapshot


def test_audited_routes_run_beside_one_another(spark, sf_dir, monkeypatch):
    every = Barrier(2, timeout=30)

    def run(spark, sf, first):
        every.wait()  # fails where one route waits for the end of the other
        for source in (first, first + 1):
            yield None, S.FULL, dict.fromkeys([*AUDITED, "target_row_count"], 0) | {
                "source_row_count": source}

    monkeypatch.setattr(route_queries, "_ROUTES",
                        {"b": (run, {"first": 10}), "a": (run, {"first": 20})})
    rows = route_queries.route_audit(spark, sf_dir).collect()
    assert [(r.route, r.load_id, r.source_row_count) for r in rows] == [
        ("b", 1, 10), ("b", 2, 11), ("a", 1, 20), ("a", 2, 21)]


@pytest.mark.parametrize("how", [{}, {"null_safe": False}, {"load_type": "FULL"},
                                 {"load_type": "APPEND_ONLY", "null_safe": False}])
def test_reduced_changes_are_not_gathered_again(spark, folder, how):
    rng = random.Random(23)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([1, 2, None]), rng.choice("pqrs"),
             rng.choice([0, 1, 2, 5, None]), rng.choice([None, "1", "2", "10"]))
            for _ in range(60)]
    old = target(spark, *[(k, n, v) for k in ("a", "c", "z", None) for n in (1, 2, None)
                          for v in "ps"])
    fewer = snapshot(reduced_changes(changes(spark, *rows), KEYS, **how), f"{folder}/staged")
    out = apply_changes(old, fewer, KEYS, load_ts=TS, reduced=True, **how)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    assert got(out) == got(apply_changes(old, fewer, KEYS, load_ts=TS, **how))


@pytest.mark.parametrize("load_type, null_safe, delete_keys, reduced", [
    (S.INCREMENTAL, True, (), True), (S.INCREMENTAL, True, ("k1",), True),
    (S.INCREMENTAL, True, ("v",), False), (S.APPEND_ONLY, True, (), False),
    (S.APPEND_ONLY, False, (), True)])
def test_loads_say_what_is_reduced(spark, folder, monkeypatch, load_type, null_safe, delete_keys,
                                   reduced):
    told = []

    def applied(*args, **how):
        told.append(how["reduced"])
        return apply_changes(*args, **how)

    monkeypatch.setattr(sync, "apply_changes", applied)
    held = ManifestTarget(spark, f"{folder}/held")
    held.redefine(target(spark, ("a", 1, "old")), "load0")
    spec = LoadSpec(id=1, route="SRC2GP" if null_safe else "SRC2RDS", load_type=load_type,
                    source_schema="app", source_table="t", target_schema="app", target_table="t",
                    keys=tuple(KEYS), delete_keys=delete_keys, stamp=S.LOAD_STAMP)
    load_changes(spark, spec, changes(spark, ("a", 1, "new", 1, "2"), ("a", 1, "newer", 1, "3")),
                 held, now=datetime(2024, 2, 1), load_id=1, counts={})
    assert told and set(told) == {reduced}
    assert sorted(r.v for r in held.read().collect()) == {
        (S.APPEND_ONLY, True): ["new", "newer"]}.get((load_type, null_safe), (
            ["newer", "old"] if delete_keys == ("v",) else ["newer"]))
