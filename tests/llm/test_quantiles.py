"""Dyadic Count-sketches: accuracy within the bound, merging and deletion."""

import math
import random
from datetime import datetime

import numpy as np
from pyspark.sql import functions as F

from vacantia.llm import quantiles as q

KEYS = ["g"]


def states(spark, rows):
    return q.partials(spark.createDataFrame(rows, "g string, v double, sketch int"), KEYS, "v")


def exact(values, p):
    return sorted(values)[max(1, math.ceil(p / 100 * len(values))) - 1]


def close(a, b):
    return abs(a - b) <= 0.0012 * abs(b) + 0.011


def rank_error(values, found, p):
    s = np.sort(values)
    rank = max(1, math.ceil(p / 100 * len(s)))
    low, high = np.searchsorted(s, found - abs(found) * 0.0012 - 0.011) + 1, np.searchsorted(s, found + abs(found) * 0.0012 + 0.011, "right")
    return 0 if low <= rank <= high else min(abs(rank - low), abs(rank - high)) / len(s)


def test_small_groups_are_sketches_too(spark):
    rng = random.Random(1)
    data = {g: [round(rng.choice([-1, 1, 1, 1]) * rng.lognormvariate(8, 3), 2) for _ in range(n)] for g, n in (("a", 1), ("b", 7), (None, 200))}
    rows = [(g, v, 1) for g, vs in data.items() for v in vs] + [("a", None, 1), ("a", float("nan"), 1), ("z", None, 1)]
    got = {r["g"]: r for r in q.percentiles(states(spark, rows), KEYS).collect()}
    assert set(got) == set(data)
    for g, vs in data.items():
        assert got[g]["n"] == len(vs) and got[g]["rank_bound"] > 0
        assert all(rank_error(vs, got[g][f"p{p}"], p) <= min(got[g]["rank_bound"], 0.01) for p in q.PERCENTS)


def test_huge_values_are_told_apart(spark):
    values = [-9e18, -1e15, 0.0, 5.0, 1e15, 3e15, 9e18, 1e300]
    got = q.percentiles(states(spark, [("a", v, 1) for v in values]), KEYS, (12, 25, 50, 62, 75, 87, 99)).first()
    assert all(close(got[f"p{p}"], exact(values, p)) for p in (12, 25, 50, 62, 75, 87, 99))


def test_large_groups_stay_within_the_bound(spark):
    rng = np.random.default_rng(2)
    data = {"normal": rng.normal(50_000, 12_000, 20_000), "ties": np.repeat([1.0, 30_000.0, 60_000.0], 4000), "wide": np.exp(rng.uniform(0, 20, 20_000)), "small": rng.normal(0, 3, 3000)}
    data["ties"] = np.concatenate([data["ties"], rng.uniform(0, 1e5, 4000)])
    rows = [(g, float(v), 1) for g, vs in data.items() for v in vs]
    got = q.percentiles(states(spark, rows), KEYS).collect()
    for r in got:
        errors = [rank_error(data[r["g"]], r[f"p{p}"], p) for p in q.PERCENTS]
        assert 0 < r["rank_bound"] < 0.12 and max(errors) <= min(r["rank_bound"], 0.03)


def test_merging_and_deletion(spark):
    rng = random.Random(3)
    days = {d: [(g, rng.lognormvariate(10, 1), d) for g in ("a", "b") for _ in range(900 if g == "a" else 90)] for d in (1, 2, 3)}
    kept = [states(spark, days[d]) for d in days]
    whole = states(spark, [r for d in days for r in days[d]])

    def same(x, y):
        side = [{r["g"]: tuple(r) for r in f.collect()} for f in (x, y)]
        assert side[0] == side[1]

    merged = q.merge(kept[0].unionByName(kept[1]).unionByName(kept[2]), KEYS)
    same(merged, whole)
    signed = whole.withColumn("s", F.lit(1)).unionByName(kept[2].withColumn("s", F.lit(-1)))
    same(q.percentiles(q.merge(signed, KEYS, "s"), KEYS), q.percentiles(q.merge(kept[0].unionByName(kept[1]), KEYS), KEYS))
    gone = q.merge(kept[0].withColumn("s", F.lit(1)).unionByName(kept[0].withColumn("s", F.lit(-1))), KEYS, "s")
    assert q.percentiles(gone, KEYS).count() == 0
    assert q.percentiles(q.merge(kept[0].limit(0), KEYS), KEYS).count() == 0


def test_extreme_values_keep_their_order(spark):
    values = [-math.inf, -1e300, -1.0, -0.001, 0.0, 0.001, 1.0, 1e300, math.inf]
    codes = [r["c"] for r in spark.createDataFrame([(v,) for v in values], "v double").select(q.encode(F.col("v")).alias("c")).collect()]
    assert codes == sorted(codes) and 0 <= codes[0] and codes[-1] < 1 << q.BITS


def test_last_delivery_counts(spark):
    at = [datetime(2025, 1, d) for d in (1, 2)]
    rows = [("d1", at[0], "p", "1", "IE", 10.0, 9), ("d1", at[1], "p", "1", "IE", 20.0, 9), ("d1", at[1], "p", "1", "IE", 20.0, 9), ("d2", at[0], "p", "1", "IE", 30.0, 9), ("d2", at[0], "q", None, None, 5.0, 9)]
    df = spark.createDataFrame(rows, "snapshot_date string, delivered_at timestamp, posting_id string, isco_code string, country string, salary_annual_eur_p50 double, n int")
    got = {(r["snapshot_date"], r["isco_code"]): (r["n"], r["value"]) for r in q.salary_percentiles(df).filter("percent = 50").collect()}
    assert {k: n for k, (n, _) in got.items()} == {("d1", "1"): 1, ("d2", "1"): 1, ("d2", None): 1, ("all", "1"): 2, ("all", None): 1}
    assert close(got["d1", "1"][1], 20) and close(got["all", "1"][1], 20)
    assert q.salary_percentiles(df.limit(0)).count() == 0
