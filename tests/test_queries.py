"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    own = {name for name, run in entry.queries().items()
           if not run.__module__.startswith(("tidemark.llm", "corpus_pipeline"))}
    assert own <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[-2:] == ["hvr_is_deleted", "load_ts"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, db, name):
    df = entry.queries()[name](spark, sf_dir)
    assert compare(df, db, entry.oracle_sql()[name]) is None
