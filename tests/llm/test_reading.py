"""Reading levels: held-out accuracy on styles that shuffle the same words, and edges."""

import random

from pyspark.sql import functions as F

from vacantia.llm import reading

EASY = ["we move the boxes", "they sell good food", "you sort old files", "we count the fruit", "they load the van"]
PLAIN = ["our department will review weekly reports", "you will prepare delivery schedules for partners", "the manager compares survey answers", "together with the team you update guidelines"]
HARD = ["notwithstanding prevailing remuneration frameworks", "the consortium operationalises econometric estimations", "that which the one side took to be meant", "has yet to be weighed against all that those say", "necessitating methodological harmonisation"]
DOCS, GRADES = "doc_id long, text string, lang string, level int, pairs int", "doc_id long, rater int, level int, lang int"


def make(n, seed=1):
    rng = random.Random(seed)
    docs, grades, truth = [], [], {}
    for i in range(n):
        level = rng.randint(1, 3)
        style = (EASY, PLAIN, HARD)[level - 1]
        text = ". ".join(rng.choice(style) for _ in range(16)) + ". Apply with <b>Larpara</b> today."
        docs.append((i, text, rng.choice(["en", "EN", "en-IE", "en_XX"]), 1, 1))
        truth[i] = level
        if rng.random() < 0.4:
            said = level if rng.random() > 0.08 else rng.randint(1, 3)
            grades += [(i, k, said, 0) for k in range(rng.randint(1, 2))]
    return docs, grades, truth


def test_held_out_accuracy(spark):
    docs, grades, truth = make(400)
    got = reading.reading_levels(spark.createDataFrame(docs, DOCS), spark.createDataFrame(grades, GRADES), hold_out=F.col("doc_id") % 4 == 0).collect()
    assert {r["doc_id"] for r in got} == set(truth)
    assert sum(r["level"] == truth[r["doc_id"]] for r in got) >= 0.97 * len(got)
    assert all(1 <= r["score"] <= 3 and r["residual"] <= reading.TOLERANCE and r["rounds"] < reading.ROUNDS for r in got)


def test_only_readable_documents(spark):
    w = "we move the boxes and they sell food " * 8
    docs = [(1, w, "en", 1, 1), (2, w, None, 1, 1), (3, w, "el", 1, 1), (4, None, "de", 1, 1), (5, "", "fr", 1, 1), (6, "too short", "en", 1, 1), (7, w * 2000, "FR-ca", 1, 1), (8, "1 2 3 " * 30, "de", 1, 1), (9, " ".join(["w"] * 49), "en", 1, 1), (10, " ".join(["word"] * 50), "en", 1, 1)]
    grades = [(1, 1, 1, 0), (1, 2, 9, 0), (None, 1, 2, 0), (99, 1, 3, 0)]
    got = {r["doc_id"]: r["level"] for r in reading.reading_levels(spark.createDataFrame(docs, DOCS), spark.createDataFrame(grades, GRADES)).collect()}
    assert set(got) == {1, 7, 8, 10} and set(got.values()) <= {1, 2, 3}


def test_no_grades_and_no_documents(spark):
    docs, _, truth = make(12)
    none = spark.createDataFrame([], GRADES)
    assert {r["level"] for r in reading.reading_levels(spark.createDataFrame(docs, DOCS), none).collect()} == {2}
    assert reading.reading_levels(spark.createDataFrame([], DOCS), none).count() == 0


def test_joined_by_shuffle_beyond_the_broadcast_bound(spark):
    docs, grades, _ = make(60, 3)
    d, g = spark.createDataFrame(docs, DOCS), spark.createDataFrame(grades, GRADES)
    few = {r["doc_id"]: round(r["score"], 9) for r in reading.reading_levels(d, g).collect()}
    before = reading.FEW
    for bound in (1, 20, 60):
        reading.FEW = bound
        many = {r["doc_id"]: round(r["score"], 9) for r in reading.reading_levels(d, g).collect()}
        reading.FEW = before
        assert few == many
