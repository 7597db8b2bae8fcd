"""Every query of this subpackage that has SQL equals it on the smallest tables."""

import pytest

from lavra.llm import queries
from tests.oracle import connect, rows, sql_rows


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, small, con, name):
    df = queries.QUERIES[name](spark, small)
    names, want = sql_rows(con, queries.SQL[name])
    assert sorted(df.columns) == names and rows(df) == want
