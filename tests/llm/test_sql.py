"""Every query of the subpackage with SQL gives the rows that DuckDB gives."""

import oracle
import pytest

from quern.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    ours, theirs = oracle.compare(queries.QUERIES[name](spark, sf_dir), queries.ORACLES[name], oracle.connection(sf_dir))
    assert (ours[:3], theirs[:3]) == ([], [])
