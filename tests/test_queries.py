"""Every registered query on the smallest tables: against its SQL where there is one, else that it runs."""

import os

import pytest

from checks import compare, connect
from workload import QUERIES, SQL

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip(f"no test tables at {SF}")
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in SQL:
        assert compare(df, con, SQL[name], tol=2e-6) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
