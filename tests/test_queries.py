"""Every core query with SQL equals it; the others run with a stable schema."""

import pytest

from lavra.plans import catalogue
from tests.oracle import connect, rows, sql_rows


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, small, con, name):
    df = catalogue.QUERIES[name](spark, small)
    got = rows(df)
    if name in catalogue.SQL:
        names, want = sql_rows(con, catalogue.SQL[name])
        assert sorted(df.columns) == names
        assert got == want
    else:
        assert df.columns
