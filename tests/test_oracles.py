"""Every query with SQL agrees with DuckDB on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.check_oracles import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, SF) == ""


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["word", "freq", "score"] and df.count() == 100


def test_whole_job(spark):
    mined = queries()["mined_vocabulary"](spark, SF)
    assert mined.columns == ["word", "score"] and mined.count() <= 100
