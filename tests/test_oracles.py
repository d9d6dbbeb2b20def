"""Every core query against its SQL on the smallest tables."""

import pytest

from same import check
from vacantia.plans import market, market_sql, problems


@pytest.mark.parametrize("name", sorted({**market_sql.SQL, **problems.SQL}))
def test_query_equals_sql(spark, data, duck, name):
    check(spark, data, duck, name)


@pytest.mark.parametrize("name", sorted((set(market.QUERIES) | set(problems.QUERIES)) - set(market_sql.SQL) - set(problems.SQL)))
def test_query_runs(spark, data, name):
    df = {**market.QUERIES, **problems.QUERIES}[name](spark, data)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)
