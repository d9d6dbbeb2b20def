"""Token-set similarity: goldens, a plain rendering, and top-1 with its ties."""

import random

from hypothesis import given
from hypothesis import strategies as st

from vacantia.operators import normalise, similarity
from vacantia.operators.similarity import lcs, token_set_ratio

LABELS = [("6221", "Kelp growers", "preferred"), ("6221", "kelp harvester", "alt"), ("8350", "ferry deckhand", "alt"), ("8350", "Deck crews", "preferred"), ("5161", "tide reader", "alt"), ("2612", "harbour judge", "alt")]


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@given(st.text("abc ", max_size=40), st.text("abc ", max_size=40))
def test_lcs_equals_dynamic_programming(a, b):
    assert lcs(a, b) == plain_lcs(a, b)


@given(st.text("ab c", max_size=20), st.text("ab c", max_size=20))
def test_ratio_is_symmetric_and_bounded(a, b):
    r = token_set_ratio(a, b)
    assert 0 <= r <= 100 and abs(r - token_set_ratio(b, a)) < 1e-9
    assert r == 0 or token_set_ratio(a, a) == 100
    for floor in (0, 50, 85):
        assert token_set_ratio(a, b, floor) == (r if r >= floor else 0)


def test_best_labels(spark):
    titles = ["kelp harvester", "Junior Kelp Harvester (Galway)", "HARBOUR JUDGE", "Ferry deckhands", "Stained Glass Restorer", "", None, "tide", "Kelp Harvestor", "kelp  harvester"]
    labels = spark.createDataFrame(LABELS, "isco_code string, label string, label_kind string")
    got = {r["title"]: r for r in similarity.best_labels(spark.createDataFrame([(t,) for t in titles], "title string"), labels).collect()}
    assert {t: r["isco_code"] for t, r in got.items()} == {"kelp harvester": "6221", "Junior Kelp Harvester (Galway)": "6221", "HARBOUR JUDGE": "2612", "Ferry deckhands": "8350", "tide": "5161", "Kelp Harvestor": "6221", "kelp  harvester": "6221"}
    assert got["kelp harvester"]["score"] == 100 and 85 <= got["Kelp Harvestor"]["score"] < 100


def test_best_labels_equals_brute_force(spark):
    rng = random.Random(1)
    words = ["data", "analyst", "engineer", "enginer", "sales", "manager", "nurse", "senior", "head"]
    titles = sorted({" ".join(rng.sample(words, rng.randint(1, 4))) for _ in range(120)})
    rows = [(str(1000 + i), " ".join(rng.sample(words, rng.randint(1, 3))), "alt") for i in range(40)]
    labels = spark.createDataFrame(rows, "isco_code string, label string, label_kind string")
    ordered = sorted(set(rows), key=lambda r: (r[0], r[2], r[1]))
    want = {}
    for t in titles:
        scores = [token_set_ratio(t, r[1]) for r in ordered]
        if max(scores) >= 85:
            want[t] = (ordered[scores.index(max(scores))][0], round(max(scores), 6))
    similarity.BLOCK, before = 7, similarity.BLOCK
    got = {r["title"]: (r["isco_code"], round(r["score"], 6)) for r in similarity.best_labels(spark.createDataFrame([(t,) for t in titles], "title string"), labels).collect()}
    similarity.BLOCK = before
    assert got == want


def test_no_labels(spark):
    none = spark.createDataFrame([], "isco_code string, label string, label_kind string")
    assert similarity.best_labels(spark.createDataFrame([("x",)], "title string"), none).count() == 0


@given(st.lists(st.text("ab c", min_size=1, max_size=12).filter(str.strip), min_size=1, max_size=12), st.text("ab c", max_size=14), st.sampled_from([1.0, 50.0, 85.0, 100.0]))
def test_label_index_equals_scoring_every_label(labels, title, cutoff):
    scores = [token_set_ratio(title, x) for x in labels]
    want = (scores.index(max(scores)), max(scores)) if max(scores) >= cutoff else None
    got = similarity.LabelIndex(list(enumerate(labels))).best(title, cutoff)
    assert (got is None) == (want is None)
    if want:
        assert got[0] == want[0] and abs(got[1] - want[1]) < 1e-9


def test_classifier_hook(spark):
    df = spark.createDataFrame([("a", "Kelp Harvester", "old"), ("b", "Bell Welder", "old"), ("c", "Stained Glass Restorer", "old"), ("d", None, "old")], "posting_id string, title string, isco_code string")
    labels = spark.createDataFrame(LABELS, "isco_code string, label string, label_kind string")
    asked = []

    def classify(titles):
        asked.extend(r["title"] for r in titles.collect())
        return titles.filter("title LIKE '%Welder'").selectExpr("title", "'7212' AS isco_code", "0.75 AS confidence")

    got = {r["posting_id"]: (r["isco_code"], r["isco_match_method"], r["isco_match_score"]) for r in normalise.tagged(df, labels, classify=classify).collect()}
    assert got == {"a": ("6221", "fuzzy", 1.0), "b": ("7212", "llm", 0.75), "c": (None, "none", None), "d": (None, "none", None)}
    assert sorted(t for t in asked if t) == ["Bell Welder", "Stained Glass Restorer"]
