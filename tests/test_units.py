"""Units read from payloads, and the mixture where none is stated."""

import json
import random
from datetime import datetime

from vacantia.operators import units

SCHEMA = "posting_id string, country string, salary_min_eur double, salary_max_eur double, salary_period string, ingested_at timestamp, raw_payload string, currency string, scale int"
RATES = [("IE", "EUR", 1.0), ("GB", "GBP", 0.8), ("CA", "CAD", 1.5), ("US", "USD", 1.1), ("PL", "PLN", 4.0)]
AT = datetime(2025, 1, 1)


def text(s, key="description"):
    return json.dumps({"id": "8 per hour", key: s})


def pay(**c):
    return json.dumps({"id": "1", "compensation": {"compensationTiers": [{"components": [{"componentType": "Salary"} | c]}]}})


def run(spark, rows):
    postings = spark.createDataFrame([(f"p{i}", *r[:4], AT, r[4], "x", 1) for i, r in enumerate(rows)], SCHEMA)
    got = units.salary_units(postings, spark.createDataFrame(RATES, "country string, currency string, rate double")).collect()
    return {(int(r["posting_id"][1:]), r["bound"]): r for r in got}


def test_stated_units(spark):
    noise = " We work 40 hours per week. You have 25 days of leave per year. Training budget is agreed each year."
    cases = [
        (("IE", 30000.0, None, "annual", None), 30000), (("IE", 20.0, None, "hourly", text("Nice." + noise)), 41600), (("GB", 100.0, None, "daily", "<position><id>9</id></position>"), 32625),
        (("IE", 45500.0, None, None, text("Salary: 45,500 EUR per year.")), 45500), (("GB", 170.0, None, None, text("We offer GBP 170–190/day, depending on experience.")), 55463),
        (("IE", 2550.0, None, "annual", text("Rate of €2.550-2800 per month." + noise)), 30600), (("CA", 74.5, None, "annual", text("(74.5–107K $ per year)")), 49667), (("CA", 74500.0, None, "annual", text("(74.5–107K CAD per year)")), 49667),
        (("IE", 5.2, None, None, text("Remuneration 5.2–7.3 Tsd. € per month;")), 62400), (("IE", 18.0, None, "annual", text("Gehalt: 18 bis 21 EUR pro Stunde.", "content")), 37440), (("PL", 3150.0, None, "monthly", text("(£3.15 to 4.4 Tsd.)")), 47250),
        (("US", 2350.0, None, "annual", text("<p>Package of 2 350 to 2,800 USD p.w. plus benefits.</p>")), 111091), (("IE", 1450000.0, None, None, pay(interval="1 WEEK", currencyCode="EUR", minValue=1450000.0, valueUnit="minor")), 754000),
        (("IE", 66.5, None, "annual", pay(interval="per-year-salary", currencyCode="EUR", minValue=66.5, valueUnit="k")), 66500), (("IE", 66500.0, None, "annual", pay(interval="yearly", currencyCode="GBP", minValue=66.5, valueUnit="thousands")), 83125),
        (("GB", 205.0, None, "annual", "<position><compensation><componentType>Salary</componentType><interval>per-day-wage</interval><currencyCode>EUR</currencyCode><minValue>205.0</minValue></compensation></position>"), 53505),
    ]
    got = run(spark, [c for c, _ in cases])
    assert {i: got[i, "min"]["eur_per_year"] for i in range(len(cases))} == {i: want for i, (_, want) in enumerate(cases)}
    assert all(r["stated"] and not r["uncertain"] for r in got.values())


def test_unstated_units_follow_the_mixture(spark):
    rng = random.Random(3)
    rows, truth = [], []
    for i in range(1500):
        yearly = rng.lognormvariate(10.8, 0.25)
        period = rng.choice(["annual", "monthly", "hourly"])
        rows.append(("IE", yearly / units.PER_YEAR[period], None, period if i % 3 else None, None))
        truth.append(period)
    got = run(spark, rows)
    open_rows = [i for i in range(1500) if i % 3 == 0]
    sure = [i for i in open_rows if not got[i, "min"]["uncertain"]]
    assert not any(got[i, "min"]["stated"] for i in open_rows)
    assert len(sure) > 0.9 * len(open_rows)
    assert sum(got[i, "min"]["period"] == truth[i] for i in sure) > 0.97 * len(sure)


def test_edges(spark):
    got = run(spark, [(None, 10.0, None, "annual", "{cut"), ("IE", 0.0, -5.0, None, ""), ("XX", 10.0, None, "monthly", None), ("IE", None, None, "annual", "x" * 200_000), ("IE", float("inf"), None, "annual", None)])
    assert got[0, "min"]["eur_per_year"] is None and got[2, "min"]["eur_per_year"] is None and (3, "min") not in got
    assert got[1, "min"]["uncertain"] and got[1, "max"]["uncertain"] and got[4, "min"]["eur_per_year"] is None
    assert run(spark, []) == {}
