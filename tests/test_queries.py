"""Every registered query against its SQL (or, without SQL, against its row count)."""

import os

import pytest

import __spark_entry__ as entry
from sql_check import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    if name in ORACLE:
        assert difference(df, con, ORACLE[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracle_names():
    assert set(ORACLE) <= set(entry.queries())
