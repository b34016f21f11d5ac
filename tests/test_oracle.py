"""Every registered query with SQL agrees with it on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, sf_dir, con, name):
    assert difference(entry.queries()[name](spark, sf_dir), con, SQL[name]) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry_has_rows_and_the_contract_columns(spark):
    from dispatchlens import policy
    df = entry.entry(spark)
    assert df.columns == [*policy.FEATURES, policy.ORDER_ID, policy.LABEL, policy.PURCHASE_TS]
    assert df.count() > 0
