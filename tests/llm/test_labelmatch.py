"""Titles to labels: goldens, edges, and the pigeonhole join against every pair."""

import random

from vacantia.llm import labelmatch

LABELS = [("1", "Data analyst", "preferred"), ("1", "Datenanalyst", "alt"), ("2", "Glazier", "preferred"), ("3", "Nurse", "preferred"), ("4", "Nurse manager", "preferred"), ("5", "Chef", "preferred"), ("6", "Project manager", "preferred"), ("7", "Product manager", "preferred"), ("8", "Network technician", "preferred"), ("9", "Model training engineer", "alt")]
SCHEMA = "posting_id string, title string, isco_code string, label string, salt int"


def run(spark, titles, labels=LABELS):
    df = spark.createDataFrame([(f"p{i}", t, None, "x", 1) for i, t in enumerate(titles)] + [("known", "Nurse", "3", "x", 1)], SCHEMA)
    got = labelmatch.match_titles(spark, df, spark.createDataFrame(labels, "isco_code string, label string, label_kind string"))
    rows = got.collect()
    assert len(rows) == len({r["posting_id"] for r in rows}) == len(titles)
    by = {r["posting_id"]: r for r in rows}
    return [by[f"p{i}"] for i in range(len(titles))]


def test_typed_titles(spark):
    cases = {
        "Senior Data Analyst - Poultry Scheduling, Zenmiqua": "1", "Voucher Pricing: Data Annlyst (Tamguqua)": "1", "DATAANALYST": "1", "Data-Analyst (Lead)": "1", "Analyst, Data - Tram Reporting": "1", "Guide, Glacier - Hostel Mapping, Kyovinth": "none",
        "Glazier, Hostel Mapping / Kyovinth": "2", "Glaazier": "2", "Nurse Manager - Clinic": "4", "Head Nurse Person Something": "none", "Cehf": "5", "Porduct Mannager": "7", "Projet Manager": "6", "LAN / Network techn. – Bridge": "8",
        "Zenmiqua | Mortgage Enablement – Snr Network tech": "8", "Training, Engineer, Model, Paper Sourcing / Oxaduven": "9", "Fog Signal Keeper": "none", "": "none", None: "none", "  ": "none", "🚀": "none", "x" * 50_000: "none", "nurse " * 3000: "none",
    }
    got = run(spark, list(cases))
    assert [r["isco_code"] for r in got] == list(cases.values())
    assert all((r["isco_match_score"] == 0) == (r["isco_code"] == "none") and 0 <= r["isco_match_score"] <= 1 for r in got)
    assert got[0]["isco_match_score"] == 1 and got[1]["isco_match_score"] < 1


def test_empty_tables(spark):
    assert [r["isco_code"] for r in run(spark, ["Nurse"], [("1", None, "alt"), (None, "Nurse", "alt")])] == ["none"]
    assert run(spark, []) == []


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_pigeonhole_join_loses_no_pair(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(2, 20))) for _ in range(60)]
    titles = []
    for w in words * 4:
        letters = list(w)
        for _ in range(rng.randint(0, 5)):
            k = rng.randrange(len(letters) + 1)
            rng.choice([lambda: letters.insert(k, rng.choice("abcde")), lambda: letters.pop(min(k, len(letters) - 1)) if letters else None])()
        titles.append("".join(letters))
    got = run(spark, titles, [(str(i), w, "alt") for i, w in enumerate(words)])
    for t, r in zip(titles, got):
        near = []
        for w in words:
            d, n = distance(t, w), len(w)
            if d <= (1 if n <= 5 else 2 if n <= 11 else 3 if n <= 15 else 4) or (d == 2 and n <= 5 and sorted(t) == sorted(w)):
                near.append(d)
        assert (r["isco_code"] == "none") == (not near or not t), t
        if near and t:
            assert distance(t, r["label"]) == min(near)
