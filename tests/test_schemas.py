"""The contracts report every broken rule at once."""

from datetime import datetime

import pytest

from vacantia import schemas

AT = datetime(2025, 1, 1)
GOOD = ("a", "s", "Nurse", None, None, "IE", None, None, 1.0, 2.0, "annual", 1.5, None, AT, AT, "http://x", "1234", "fuzzy", 0.5, None)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.POSTING.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ").replace(",", ", ")) if rows else spark.createDataFrame([], schemas.POSTING)


def with_(**values):
    return tuple(values.get(n, v) for n, v in zip(schemas.POSTING.names, GOOD))


def test_good_rows_pass(spark):
    assert schemas.validate(frame(spark, GOOD, with_(posting_id="b", isco_code=None, salary_period=None)), schemas.POSTINGS).count() == 2
    assert schemas.validate(frame(spark), schemas.POSTINGS).count() == 0


def test_all_failures_are_listed(spark):
    rows = [GOOD, GOOD, with_(posting_id="b", title="", country="IRL", salary_min_eur=-1.0), with_(posting_id="c", posted_at=None, posting_url="ftp://x", isco_code="12a4", isco_match_method="guess", isco_match_score=1.5, salary_period="fortnight", title="x" * 501, salary_max_eur=2e7)]
    with pytest.raises(schemas.ContractError) as e:
        schemas.validate(frame(spark, *rows), schemas.POSTINGS)
    assert e.value.broken == {
        "posted_at not null": 1, "title length": 2, "country length": 1, "salary_min_eur range": 1, "salary_max_eur range": 1, "salary_period values": 1, "posting_url prefix": 1,
        "isco_code form": 1, "isco_match_method values": 1, "isco_match_score range": 1, "posting_id unique": 1,
    }


def test_columns_are_strict(spark):
    with pytest.raises(schemas.ContractError, match="extra"):
        schemas.conform(frame(spark, GOOD).selectExpr("*", "1 AS extra"), schemas.POSTINGS)
    with pytest.raises(schemas.ContractError, match="title missing"):
        schemas.conform(frame(spark, GOOD).drop("title"), schemas.POSTINGS)
