import pytest
from compare import differences

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), SQL[name], SF_DIR) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 30


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
