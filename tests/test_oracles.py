"""Every query with SQL gives what the SQL gives."""

import pytest

from millrace.plans.queries import ORACLE, QUERIES

from .oracle import database, same


@pytest.fixture(scope="module")
def con(sf_dir):
    return database(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, con, name):
    same(QUERIES[name](spark, sf_dir), con, ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
