"""Queries of this package that SQL can express, on the same tables."""

import pytest

import oracle
from sparkmart.llm import queries


@pytest.mark.parametrize("name", ["op4_near_dedup", "op12_spelling_variants", "chat_digests", "quality_counts", "personal_data_base"])
def test_sql(spark, sf_dir, name):
    con, df = oracle.connect(sf_dir), queries.QUERIES[name](spark, sf_dir)
    got, want = oracle.spark_rows(df), oracle.sql_rows(con, queries.ORACLES[name])
    assert sum(want[1].values()) > 0 and got == want
    assert not oracle.types_differ(df, con, queries.ORACLES[name])
