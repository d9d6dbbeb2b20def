"""Containers: nothing lost, split or overfull, and little unused."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from vacantia.llm import packing


def plain_padding(sizes, counts, buckets):
    n, inf = len(sizes), float("inf")
    best = [[inf] * (n + 1) for _ in range(buckets + 1)]
    best[0][0] = 0
    for b in range(1, buckets + 1):
        best[b][0] = 0
        for j in range(1, n + 1):
            best[b][j] = min(best[b - 1][i] + sum((sizes[j - 1] - sizes[k]) * counts[k] for k in range(i, j)) for i in range(j))
    return best[buckets][n]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 9), min_size=1, max_size=12), st.integers(1, 5))
def test_buckets_are_optimal(hist, buckets):
    sizes, counts = np.array(sorted(hist)), np.array([hist[s] for s in sorted(hist)])
    uppers = packing.length_buckets(sizes, counts, buckets)
    of = np.searchsorted(uppers, sizes)
    assert len(uppers) <= buckets and uppers[-1] == sizes[-1]
    assert int(((uppers[of] - sizes) * counts).sum()) == plain_padding(list(sizes), list(counts), buckets)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), min_size=1, max_size=15))
def test_plan_places_every_item_once(hist):
    uppers, counts = np.array(sorted(hist)), np.array([hist[s] for s in sorted(hist)])
    segments, containers = packing.plan(uppers, counts, 50)
    load = [0] * containers
    for b in range(len(uppers)):
        mine = sorted((f, m, base) for x, f, m, base in segments if x == b)
        for rank in range(counts[b]):
            f, m, base = [s for s in mine if s[0] <= rank][-1]
            load[base + (rank - f) // m] += int(uppers[b])
    assert max(load) <= 50 and min(load) > 0 and sum(load) == int((uppers * counts).sum())


def check(rows, items, capacity):
    by_item, by_container = {}, {}
    for r in rows:
        by_item.setdefault(r["id"], []).append((r["piece_no"], r["start"], r["n_tokens"]))
        by_container[r["container_id"]] = by_container.get(r["container_id"], 0) + r["n_tokens"]
    assert max(by_container.values()) <= capacity and sorted(by_container) == list(range(len(by_container)))
    sizes = {}
    for i, s in items:
        sizes.setdefault(i, []).append(max(s or 0, 0))
    for i, whole in sizes.items():
        assert sum(n for *_, n in by_item[i]) == sum(whole)
        if len(whole) == 1:
            pieces = sorted(by_item[i])
            assert [p for p, *_ in pieces] == list(range(max(1, -(-whole[0] // capacity))))
            assert all(start == p * capacity for p, start, _ in pieces)
    return by_container


def run(spark, items, capacity=100, **more):
    df = spark.createDataFrame([(i, s, 1, 2) for i, s in items], "id long, size int, container_id int, _key int")
    rows = packing.pack(df, "id", "size", capacity, **more).collect()
    return check(rows, items, capacity) if items else rows


def test_spark_packs_tightly(spark):
    rng = random.Random(2)
    items = [(i, min(900, int(rng.lognormvariate(3, 0.8)))) for i in range(4000)]
    loads = run(spark, items)
    assert sum(loads.values()) / (100 * len(loads)) > 0.97


def test_edges(spark):
    assert run(spark, []) == []
    run(spark, [(1, 0), (2, None), (3, -5)])
    run(spark, [(1, 100), (2, 101), (3, 250), (4, 300), (5, 0), (5, 7), (5, 7)])
    loads = run(spark, [(i, 30) for i in range(600)])
    assert len(loads) == 200


def test_shares(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate([50] * 4 + [70, 30, 0, 130])], "id long, size int")
    r = packing.fill(packing.pack(df, "id", "size", 100), 100).first()
    assert (r["containers"], r["pieces"], r["tokens"], r["fullest"], r["unused"]) == (5, 9, 430, 100, 0.14)
    assert r["of_one_bucket"] == 0.8 and r["in_first_batches"] == round(400 / 430, 6)
