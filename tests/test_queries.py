"""Every query against its SQL, and every query without SQL for rows."""

from __future__ import annotations

import oracle
import pytest

from tessera.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="session")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, con, name):
    assert oracle.differences(QUERIES[name](spark, sf_dir), con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.limit(1).count() == 1 and "grade" in df.columns
    assert set(QUERIES) <= set(entry.queries())
