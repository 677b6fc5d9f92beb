"""Every query that SQL can express gives the same rows on the smallest data set; all others run."""

import oracle
import pytest
from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, con, name):
    assert oracle.compare(spark, con, name, queries()[name], oracle_sql()[name], FOLDER) == ""


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
