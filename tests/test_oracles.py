"""Every query with SQL gives the rows that DuckDB gives."""

import oracle
import pytest

from quern.plans import catalogue


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connection(sf_dir)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_matches_sql(spark, sf_dir, con, name):
    ours, theirs = oracle.compare(catalogue.QUERIES[name](spark, sf_dir), catalogue.ORACLES[name], con)
    assert (ours[:3], theirs[:3]) == ([], [])


def test_every_oracle_has_a_query():
    assert set(catalogue.ORACLES) <= set(catalogue.QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
