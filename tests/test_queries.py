"""Every registered query against plain SQL over the same tables."""

import pytest

import __spark_entry__ as entry_module
import oracle
from sparkmart.plans.oracles import ORACLES as SQL
from sparkmart.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(SQL) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    got, want = oracle.spark_rows(df), oracle.sql_rows(con, SQL[name])
    assert sum(want[1].values()) > 0
    assert got == want
    assert not oracle.types_differ(df, con, SQL[name])


def test_entry(spark):
    assert entry_module.entry(spark).count() == 6000
