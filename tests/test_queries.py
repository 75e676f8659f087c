import pytest

import __spark_entry__ as driver
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["l_orderkey", "legacy_orderkey", "l_linenumber", "l_quantity", "order_id"] and df.count() > 0


@pytest.mark.parametrize("name", list(driver.queries()))
def test_query_matches_its_sql(spark, con, sf_dir, name):
    sql = driver.oracle_sql()
    df = driver.queries()[name](spark, sf_dir)
    if name in sql:
        assert compare(df, con, sql[name]) is None
    else:
        assert df.count() >= 0
