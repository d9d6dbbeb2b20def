"""Every llm query on the smallest tables: against its SQL where there is some, else that it runs."""

import pytest

from same import check
from vacantia.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, data, duck, name):
    check(spark, data, duck, name)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_runs(spark, data, name):
    df = queries.QUERIES[name](spark, data)
    df.collect()
    assert len(set(df.columns)) == len(df.columns)
