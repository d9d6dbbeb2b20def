"""Quantiles, filters and told properties against plain renderings."""

import random

from pyspark.sql import functions as F

from vacantia.operators import dashboard
from vacantia.operators.quantile import exact_quantile


def test_exact_quantile(spark):
    rng = random.Random(1)
    data = {g: [rng.choice([1.0, 2.5, rng.uniform(-5, 9)]) for _ in range(n)] for g, n in (("a", 1), ("b", 2), ("c", 51), (None, 40))}
    rows = [(g, v) for g, vs in data.items() for v in vs] + [("a", None), ("z", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    for share in (0.0, 0.25, 0.5, 0.9, 1.0):
        got = {r["g"]: (r["p50"], r["n"]) for r in exact_quantile(df, ["g"], "v", share).collect()}
        assert set(got) == set(data)
        for g, vs in data.items():
            s, at = sorted(vs), (len(vs) - 1) * share
            low = int(at)
            want = s[low] + (s[min(low + 1, len(s) - 1)] - s[low]) * (at - low)
            assert abs(got[g][0] - want) < 1e-9 and got[g][1] == len(vs)
    assert exact_quantile(df.limit(0), ["g"], "v", 0.5).count() == 0


def test_global_filter_lets_missing_salaries_pass(spark):
    df = spark.createDataFrame([("IE", "1", None, "2025-01-02"), ("IE", "1", 5.0, "2025-01-02"), ("IE", "2", 500.0, "2025-01-01"), ("GB", None, 50.0, None)], "country string, isco_major string, salary_annual_eur_p50 double, posted_at string").withColumn("posted_at", F.col("posted_at").cast("timestamp"))
    n = lambda **k: df.filter(dashboard.where(**k)).count()
    assert (n(), n(country="IE"), n(major="1"), n(low=10.0), n(high=100.0), n(low=10.0, high=100.0), n(since="2025-01-02"), n(until="2025-01-01"), n(also=F.col("country") == "GB")) == (4, 3, 2, 3, 3, 2, 2, 1, 1)


def test_told_properties(spark):
    rows = [("Senior Nurse", "x", None, None), ("Nurse", '{"d": "for a junior"}', "Dublin (Hybrid)", None), ("Nurse", None, None, True), (None, "calm, SQL and R", "Remote", None)]
    df = spark.createDataFrame(rows, "title string, raw_payload string, location_raw string, remote boolean")
    got = dashboard.with_skills(dashboard.with_arrangement(dashboard.with_experience(df)), ["sql", "r", "c"]).collect()
    assert [(r["experience_level"], r["experience_method"], r["work_arrangement"], r["skills"]) for r in got] == [("senior", "title", None, []), ("junior", "description", "hybrid", []), (None, "none", "remote", []), (None, "none", "remote", ["sql", "r"])]
    assert len(dashboard.with_skills(df, ["sql", "r", "calm"], 2).collect()[3]["skills"]) == 2


def test_histogram_and_ties(spark):
    df = spark.createDataFrame([(0.0,), (9.9,), (10.0,), (100.0,), (-1.0,), (None,)], "salary_annual_eur_p50 double")
    assert {tuple(r) for r in dashboard.histogram(df, 0, 100, 10).collect()} == {(0, 2), (1, 1)}
    t = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "title string")
    assert [r["title"] for r in dashboard.top_titles(t, 2).collect()] == ["c", "a"]
