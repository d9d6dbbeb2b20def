"""Near-duplicate openings: planted pairs and traps, the pruning rule, and edges."""

import random
import time
from pathlib import Path

import numpy as np
import pytest

from vacantia.llm import neardup

SCHEMA = "posting_id string, title string, company string, location_raw string, class_id int, words int"
JOBS = ["Data Analyst", "Glacier Guide", "Project Manager", "Product Manager", "Fog Signal Keeper", "Nurse", "Network Technician", "Baker"]
DOMAINS, ACTS = ["Water", "Waste", "Poultry", "Tram", "Solar", "Bridge"], ["Scheduling", "Mediation", "Remediation", "Pricing", "Mapping"]
TEAMS, TOWNS = ["Zenmiqua", "Larpara", "Kyoroven", "Tamtamos"], [("Gravosholt", "Ireland"), ("Lindumfeld", "Germany"), ("Falkerton", "Australia")]
COMPANIES = ["Jorwakord Textiles", "Gritiholm Homes", "Keskiclay Energy", "Lumnemint Foods"]
RANKS = {"": [""], "Senior": ["Senior", "Sr.", "Snr"], "Junior": ["Junior", "Jr."]}


def slip(rng, text):
    at = [i for i in range(1, len(text) - 1) if text[i].isalpha() and text[i + 1].isalpha()]
    i = rng.choice(at)
    return rng.choice([text[:i] + text[i + 1 :], text[:i] + text[i] + text[i:], text[:i] + text[i + 1] + text[i] + text[i + 2 :]])


def advert(rng, o, slips):
    rank, job, domain, act, team, town, company = o
    words = job.split()
    job = f"{words[-1]}, {' '.join(words[:-1])}" if len(words) > 1 and rng.random() < 0.15 else "".join(words) if rng.random() < 0.1 else job
    rank = rng.choice(RANKS[rank])
    subject = f"{domain} {act}"
    if slips and rng.random() < 0.4:
        job, subject = (slip(rng, job), subject) if rng.random() < 0.5 else (job, slip(rng, subject))
    title = rng.choice(["{r} {j} - {s}, {t}", "{r} {j} – {s} ({t})", "{s}: {r} {j} ({t})", "{t} | {s} – {r} {j}", "{r} {j}: {s} | {t}"]).format(r=rank, j=job, s=subject, t=rng.choice([team, team.upper(), f"Team {team}"])).strip()
    title = rng.choice(["", "*** ", "Hiring now: "]) + title + rng.choice(["", " (m/w/d)", " #1234", " - Hybrid", " *NEW*"])
    company = rng.choice([company, company.upper(), company + " Ltd.", "The " + company, company.split()[0]])
    place = rng.choice([f"{town[0]}, {town[1]}", town[0], f"{town[1]} - {town[0]}", f"Greater {town[0]} Area", f"{town[0]} (Hybrid)"])
    return (rng.choice([title, title.lower()]) if slips else title, company, None if rng.random() < 0.1 else place)


def make(seed, n, copies=3, slips=True):
    rng = random.Random(seed)
    openings = {(rng.choice(list(RANKS)), rng.choice(JOBS), rng.choice(DOMAINS), rng.choice(ACTS), rng.choice(TEAMS), rng.choice(TOWNS), rng.choice(COMPANIES)) for _ in range(n)}
    rows, truth = [], {}
    for o in sorted(openings):
        for _ in range(rng.randint(1, copies)):
            i = f"p{len(rows):05d}"
            t, c, p = advert(rng, o, slips)
            rows.append((i, t, c, p, 1, 2))
            truth[i] = (o, p)
    want = set()
    for a in truth:
        for b in truth:
            (x, pa), (y, pb) = truth[a], truth[b]
            if a < b and x[:5] == y[:5] and x[6] == y[6] and (pa is None or pb is None or x[5] == y[5]):
                want.add((a, b))
    return rows, want


def found(spark, rows):
    got = [tuple(r) for r in neardup.same_openings(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert len(got) == len(set(got)) and all(a < b for a, b in got)
    return set(got)


def test_planted_pairs_and_traps(spark):
    rows, want = make(1, 400)
    got = found(spark, rows + rows[:50])
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 0.01 * len(got)


def test_without_slips_all_pairs_and_no_others(spark):
    rows, want = make(2, 150, slips=False)
    assert found(spark, rows) == want


def test_edges(spark):
    t = "Nurse - Water Pricing, Larpara"
    rows = [("a", t, "Gritiholm Homes", None, 1, 1), ("b", t, "Gritiholm Homes", "Falkerton", 1, 1), ("c", t, "Gritiholm Homes", "Lindumfeld", 1, 1), ("d", t, None, None, 1, 1), ("e", t, "  ", None, 1, 1), ("f", None, "Gritiholm Homes", None, 1, 1), ("g", "", "Gritiholm Homes", None, 1, 1), ("h", "x " * 20_000, "Gritiholm Homes", None, 1, 1), (None, t, "Gritiholm Homes", None, 1, 1), ("a", t, "Gritiholm Homes", None, 1, 1)]
    assert found(spark, rows) - {("f", "g"), ("f", "h"), ("g", "h")} == {("a", "b"), ("a", "c")}
    assert found(spark, []) == set()
    classes = {r["posting_id"]: r for r in neardup.opening_classes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(classes) == set("abcfgh") and classes["a"]["class_id"] == classes["c"]["class_id"]


def company(i):
    """A made-up name, at least two letters from any other's."""
    low, high = i % 16, i // 16
    syllables = ["bab", "cec", "did", "fof", "gug", "hah", "jej", "kik", "lol", "mum", "nan", "pep", "rir", "sos", "tut", "vav"]
    return (syllables[high // 16 % 16] + syllables[high % 16] + syllables[low]).capitalize() + " Works"


@pytest.mark.parametrize("n", [3, 40, 4000])
def test_two_spellings_meet_in_tables_of_any_size(spark, n):
    titles = {"Colour Technician - Bridge Mapping": "Color Technician - Bridge Mapping", "Database Engineer - Solar Pricing": "Data Base Engineer - Solar Pricing"}
    rows = [(f"{k}{j}{i:04d}", f"{t}, Zenmiqua", company(i), None, 1, 1) for i in range(n) for j, both in enumerate(titles.items()) for k, t in zip("ab", both)]
    assert found(spark, rows) == {(f"a{j}{i:04d}", f"b{j}{i:04d}") for i in range(n) for j in (0, 1)}


def test_slips_without_a_right_spelling_meet(spark):
    titles = [f"{d} {a}, {t}" for d in DOMAINS for a in ACTS for t in TEAMS]
    rows = [(f"a{i:03d}", f"Manager - {x}", "Gritiholm Homes", None, 1, 1) for i, x in enumerate(titles)]
    rows += [("x", "Mnager - Solar Fishing, Larpara", "Gritiholm Homes", None, 1, 1), ("y", "Managre - Solar Fishing, Larpara", "Gritiholm Homes", None, 1, 1)]
    assert ("x", "y") in found(spark, rows)


def test_members_and_links_are_the_whole_result(spark):
    rows, _ = make(5, 200)
    df = spark.createDataFrame(rows, SCHEMA)
    members, links = (f.collect() for f in neardup.openings(df))
    of = {}
    for r in members:
        of.setdefault(r["class_id"], set()).add((r["posting_id"], r["town"]))
    pairs = [(c, c) for c in of] + [(r["a"], r["b"]) for r in links]
    assert all(r["a"] < r["b"] and r["a"] in of and r["b"] in of for r in links)
    got = {tuple(sorted((p, q))) for a, b in pairs for p, s in of[a] for q, t in of[b] if p != q and (not s or not t or s == t)}
    want = found(spark, rows)
    assert got <= want and len(got) >= 0.98 * len(want)


def test_similarity_is_exact_and_has_the_last_word(spark):
    words = ["alpha", "gamma", "delta"]
    cols = "id long, key string, target string, rep boolean, company array<string>, rank string, words array<string>, rare array<string>"
    nodes = spark.createDataFrame([(1, "k1", "k1", True, ["c"], "", words, []), (2, "k2", "k1", False, ["c"], "", ["alpha", "gamma", "dleta"], []), (3, "k3", "k1", False, ["c"], "", ["omega"], []), (4, "k4", "k4", True, ["c"], "", ["alpha", "gamma", "zzz"], [])], cols)
    pairs = spark.createDataFrame([(2, 1), (3, 1), (1, 4)], "x long, y long")
    assert [tuple(r) for r in neardup.verified(pairs, nodes).collect()] == [(2, 1, True)]


def test_frequent_slip_is_doubtful_whatever_the_size(spark):
    n = {"manager": 1332, "maaeer": 20, "data": 900, "dataengr": 30, "water": 380, "waste": 384, "actuary": 1568, "aktuar": 195, "lonely": 3}
    for size in (1, 10):
        words = spark.createDataFrame([(w, size * k) for w, k in n.items()], "word string, n long")
        assert {r[0] for r in neardup.doubtful(words).collect()} == {"maaeer", "dataengr"}
    titles = [f"{d} {a}, {t}" for d in DOMAINS for a in ACTS for t in TEAMS]
    rows = [(f"a{i:03d}", f"Manager - {x}", "Gritiholm Homes", None, 1, 1) for i, x in enumerate(titles)]
    rows += [(f"b{i:03d}", f"Maaeer - {titles[i]}", "Gritiholm Homes", None, 1, 1) for i in range(0, 60, 12)]
    assert found(spark, rows) == {(f"a{i:03d}", f"b{i:03d}") for i in range(0, 60, 12)}


def test_slips_of_company_names(spark):
    titles = [f"{j} - {d} {a}, {t}" for j in ("Nurse", "Baker") for d in DOMAINS[:3] for a in ACTS[:3] for t in TEAMS[:2]]
    rows = [(f"a{i:02d}", x, "Gritiholm Homes", None, 1, 1) for i, x in enumerate(titles[:10])]
    rows += [("b", titles[3], "Grtihulm Homes", None, 1, 1), ("c", titles[4], "Gritihulme Homes", None, 1, 1), ("d", titles[5], "Gritihulme Foods", None, 1, 1), ("e", titles[6], "Gritihulme", None, 1, 1), ("f", titles[20], "Lumnemint Foods", None, 1, 1), ("g", titles[20], "Lumneimnt Foods", None, 1, 1)]
    got = found(spark, rows)
    assert got >= {("a04", "c"), ("a06", "e"), ("f", "g")} and not any("d" in p for p in got)


def test_frequent_words_written_together(spark):
    titles = [f"{d} {a}, {t}" for d in DOMAINS for a in ACTS for t in TEAMS]
    rows = [(f"a{i:03d}", f"Webdeveloper - {x}", "Gritiholm Homes", None, 1, 1) for i, x in enumerate(titles)]
    rows += [(f"b{i:03d}", f"Web Developer - {titles[i]}", "Gritiholm Homes", None, 1, 1) for i in range(0, 60, 6)]
    rows += [(f"c{i:03d}", f"Developer, Web - {titles[i]}", "Gritiholm Homes", None, 1, 1) for i in range(3, 60, 6)]
    assert found(spark, rows) == {(f"a{i:03d}", f"{'c' if i % 2 else 'b'}{i:03d}") for i in range(0, 60, 3)}


def test_pruning_rule_follows_the_posterior():
    least = neardup.least_matches(16, 0.6, 0.001)
    assert least == sorted(least) and len(least) == neardup.VALUES // 16
    rng = np.random.default_rng(1)
    for similarity, kept in ((0.9, True), (0.7, True), (0.15, False)):
        p = similarity + (1 - similarity) / 256
        runs = rng.random((2000, neardup.VALUES)) < p
        alive = np.ones(2000, bool)
        for k, m in enumerate(least):
            alive &= runs[:, : 16 * (k + 1)].sum(1) >= m
        assert alive.mean() > 0.99 if kept else alive.mean() < 0.01


def test_byte_comparison(spark):
    rng = random.Random(1)
    pairs = [(rng.getrandbits(64) - 2**63, rng.getrandbits(64) - 2**63) for _ in range(50)] + [(0, 0), (-1, -1), (-1, 0), (1, 257)]
    pairs += [(a, a ^ (0xFF << 8 * k) if a ^ (0xFF << 8 * k) < 2**63 else a) for a, k in ((5, 0), (7, 3), (9, 6))]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r[0] for r in df.select(neardup._equal_bytes(df["a"], df["b"])).collect()]
    assert got == [sum((a >> 8 * k) & 255 == (b >> 8 * k) & 255 for k in range(8)) for a, b in pairs]


def test_only_members_and_links_stay_on_disk(spark):
    rows, _ = make(7, 60)
    neardup.openings(spark.createDataFrame(rows[:5], SCHEMA))  # sets the checkpoint folder
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    shuffles = lambda: {f for f in (disk.getAllFiles().apply(i).getName() for i in range(disk.getAllFiles().size())) if f.startswith("shuffle_")}
    kept, before = set(folder.iterdir()), shuffles()
    result = neardup.openings(spark.createDataFrame(rows, SCHEMA))
    end = time.time() + 10
    while shuffles() - before and time.time() < end:  # they are removed in the background
        time.sleep(0.2)
    assert not shuffles() - before
    assert len(set(folder.iterdir()) - kept) == len(result) and result[0].count() == len({r[0] for r in rows})


def test_wordings_reach_only_what_is_similar(spark):
    words = ["alpha", "delta", "gamma", "omega", "sigma"]
    nodes = [(1, True, words, []), (2, False, ["alpha", "dleta", "gamma", "omega", "sigma"], words), (3, False, ["omega"], words), (4, False, [], words)]
    df = spark.createDataFrame(nodes, "id long, rep boolean, words array<string>, read array<string>")
    assert [r[0] for r in neardup.reached(df).collect()] == [2]
