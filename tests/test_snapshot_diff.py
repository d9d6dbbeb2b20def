"""Snapshot changes against a plain rendering, and their defined edge cases."""

import random
from datetime import datetime, timedelta

from vacantia.operators.snapshot_diff import posting_changes

SCHEMA = "snapshot_date string, delivered_at timestamp, posting_id string, title string, salary_annual_eur_p50 double, change string, _at int, _key int"


def brute(rows):
    last = {}
    for d, at, k, t, s, *_ in rows:
        if d is None or k is None:
            continue
        key = (at is not None, at, t is not None, t or "", s is not None, s or 0)
        if (d, k) not in last or key > last[d, k][0]:
            last[d, k] = (key, (None if t is None else " ".join(t.split()), None if s is None else round(s * 100)))
    days = sorted({d for d, *_ in rows if d is not None})
    out = set()
    for a, b in zip(days, days[1:]):
        old, new = ({k: v for (d, k), (_, v) in last.items() if d == x} for x in (a, b))
        for k in old.keys() | new.keys():
            if k not in old:
                out.add((b, k, "added"))
            elif k not in new:
                out.add((b, k, "removed"))
            elif old[k] != new[k]:
                out.add((b, k, "changed"))
    return out


def found(spark, rows):
    got = posting_changes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(set(map(tuple, got)))
    return {tuple(r) for r in got}


def test_random_snapshots(spark):
    rng, base = random.Random(5), datetime(2025, 1, 1)
    rows = []
    for _ in range(900):
        rows.append((
            rng.choice(["2025-01-01", "2025-01-09", "2025-02-01", None] if rng.random() < 0.05 else ["2025-01-01", "2025-01-09", "2025-02-01"]), base + timedelta(minutes=rng.randrange(10**6)),
            None if rng.random() < 0.02 else f"p{rng.randrange(150)}", rng.choice(["Nurse", " Nurse", "Nurse  ", "nurse", "Head  Nurse", "Head Nurse", None, ""]), rng.choice([None, 10.0, 10.001, 10.02, 1e15]), "x", 1, 2,
        ))
    rows += rows[:100]
    assert found(spark, rows) == brute(rows)


def test_edges(spark):
    at = datetime(2025, 1, 1)
    assert found(spark, []) == set()
    assert found(spark, [("a", at, "p", "t", 1.0, None, 1, 1)]) == set()
    long = "x " * 50_000
    rows = [("a", at, "p", long, None, None, 1, 1), ("b", at, "p", long + " ", None, None, 1, 1), ("b", None, "p", "older", 1.0, None, 1, 1), ("c", at, "q", None, None, None, 1, 1)]
    assert found(spark, rows) == {("c", "p", "removed"), ("c", "q", "added")}
