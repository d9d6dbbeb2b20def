"""Problem 10: the reading level of every document.

Method: a graph whose nodes are documents and the word pairs in them. Graded documents are clamped to the mean
of their grades; difficulty then flows from documents to word pairs and back in harmonic iterations, each
node taking the weighted mean of its neighbours. An edge weighs the more the less its word pair's documents
differ, so that pairs found everywhere say little. Pairs of adjacent words, not single ones, because dense
prose may nest the commonest words. A document's own grade is left out of its final value's direct use: the
value is what its word pairs say, which also overrules a grader who erred.

Levels are cut from the values halfway between the medians of the graded documents of adjacent levels, per
language where it has graded ones of both, else over all languages.

The iterations end when no document's value moves by more than ``TOLERANCE`` of a level any more (after ``ROUNDS`` at
most). Each is one pass over the documents: the documents' pairs are kept as one array per document,
partitioned by document, and only the word pairs' sums are shuffled, combined before. The pairs' values are
broadcast while they are at most ``FEW`` rows (some 10 MB). Beyond, those of the most frequent pairs are broadcast, of
which there are ``FEW`` at most by the definition of frequent, and the others joined by shuffle, where no key has more
than a ``FEW``-th of all edges. Results are the same either way.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.runtime import BLANKS, cut_lineage, cut_partitioned, once

#: Most word pairs whose values are broadcast, and the fewest documents a pair must join to carry anything.
FEW, SHARED = 200_000, 2
#: Change of values (levels are 1 apart) from which iterations go on, and their most.
TOLERANCE, ROUNDS = 0.01, 30
#: Trust in a document that is not graded, and the spread below which word pairs no longer gain weight.
TRUST, FLOOR = 0.2, 0.02
LEVELS = (1, 2, 3)


def with_pairs(readable: DataFrame) -> DataFrame:
    """doc_id, lang and pairs: the distinct pairs of adjacent words of each text, as hashes together with the language; markup and case do not count."""
    words = F.filter(F.split(F.lower(F.regexp_replace("text", "<[^>]*>", " ")), r"[^\p{L}'’]+"), lambda w: w != "")
    rest = F.greatest(F.size("_words") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("_words", 1, rest), F.slice("_words", 2, rest), lambda a, b: F.xxhash64("lang", a, b))
    return once(readable, "_words", words).select("doc_id", "lang", F.array_distinct(pairs).alias("pairs"))


def _readable(documents: DataFrame, languages: tuple[str, ...], least_words: int) -> DataFrame:
    lang = F.lower(F.substring("lang", 1, 2))
    # splitting stops once there are enough words, so long texts are not split in whole
    first = F.split("text", f"{BLANKS}+", least_words + 2)
    long = F.size(F.filter(first, lambda w: w != "")) >= least_words
    return documents.filter(lang.isin(*languages) & F.col("text").isNotNull() & long).select("doc_id", lang.alias("lang"), "text")


def _word_values(documents: DataFrame, mean: float) -> DataFrame:
    """term, value, weight of the word pairs from the documents' ``pairs``, ``trust`` and ``value``."""
    edges = documents.filter("trust > 0").select(F.explode("pairs").alias("term"), "trust", (F.col("trust") * F.col("value")).alias("x"), (F.col("trust") * F.col("value") * F.col("value")).alias("xx"))
    sums = edges.groupBy("term").agg(F.sum("trust").alias("t"), F.sum("x").alias("x"), F.sum("xx").alias("xx"))
    spread = F.greatest(F.col("xx") / F.col("t") - (F.col("x") / F.col("t")) ** 2, F.lit(0.0))
    return sums.select("term", ((F.col("x") + 0.1 * mean) / (F.col("t") + 0.1)).alias("value"), (1 / ((spread * F.col("t") + 0.5) / (F.col("t") + 1.0) + FLOOR)).alias("weight"))


def _document_values(documents: DataFrame, words: DataFrame, frequent: Column | None) -> DataFrame:
    """doc_id and ``said``, the weighted mean of a document's word pairs; documents without known pairs are left out.

    ``frequent`` tells the word pairs (of ``words``) whose values are broadcast, None that all are."""
    edges = documents.select("doc_id", F.explode("pairs").alias("term"))
    if frequent is None:
        known = edges.join(F.broadcast(words), "term")
    else:
        often = words.filter(frequent)
        rest = edges.join(F.broadcast(often.select("term")), "term", "left_anti").join(words.filter(~frequent), "term")
        known = edges.join(F.broadcast(often), "term").unionByName(rest)
    return known.groupBy("doc_id").agg((F.sum(F.col("value") * F.col("weight")) / F.sum("weight")).alias("said"))


def difficulty(documents: DataFrame, grades: DataFrame, rounds: int = ROUNDS, languages: tuple[str, ...] = ("en", "de", "fr"), least_words: int = 50, hold_out: Column | None = None) -> DataFrame:
    """doc_id, lang (two letters), grade (mean, null if not graded), clamped, said (the difficulty that the graph gives), residual, rounds.

    Only documents of the languages with at least ``least_words`` blank-separated words take part; null texts
    never do. Grades outside 1 to 3 and of unknown documents are ignored. ``hold_out`` (a condition on doc_id)
    keeps grades from being clamped, for measuring accuracy. Without any grade all values are 2. ``residual`` is how far
    any document's value moved in the last iteration, ``rounds`` how many there were."""
    mean_grade = grades.filter(F.col("level").isin(*LEVELS) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg("level").alias("grade"))
    base = with_pairs(_readable(documents, languages, least_words)).join(mean_grade, "doc_id", "left")
    clamped = F.col("grade").isNotNull() & (~hold_out if hold_out is not None else F.lit(True))
    base = cut_partitioned(base.withColumn("clamped", clamped), "doc_id")
    # pairs of a single document join nothing
    shared = cut_lineage(base.select(F.explode("pairs").alias("term")).groupBy("term").agg(F.count("*").alias("n")).filter(F.col("n") >= SHARED))
    size = shared.agg(F.count("*").alias("terms"), F.coalesce(F.sum("n"), F.lit(0)).alias("edges")).first()
    few = size["terms"] <= FEW
    frequent = None if few else F.col("n") > size["edges"] / FEW
    mean = base.filter("clamped").agg(F.avg("grade")).first()[0] or 2.0
    said, moved, done = base.select("doc_id", F.lit(mean).alias("said")), math.inf, 0
    while done < rounds and moved > TOLERANCE:
        known = base if done == 0 else base.join(said, "doc_id", "left")
        # at first only graded documents speak
        trust = F.when(F.col("clamped"), 1.0).otherwise(TRUST if done else 0.0)
        value = F.when(F.col("clamped"), F.col("grade")).otherwise(F.coalesce("said", F.lit(mean)) if done else F.lit(mean))
        found = _word_values(known.select("pairs", trust.alias("trust"), value.alias("value")), mean)
        words = cut_lineage(found.join(F.broadcast(shared) if few else shared, "term"))
        new = _document_values(base, words, frequent)
        before = said.withColumnRenamed("said", "before")
        said = cut_lineage(new.join(before, "doc_id", "left").select("doc_id", "said", F.abs(F.col("said") - F.coalesce("before", F.lit(mean))).alias("moved")))
        moved = said.agg(F.max("moved")).first()[0] or 0.0
        said, done = said.drop("moved"), done + 1
    whole = base.drop("pairs").join(said, "doc_id", "left")
    return whole.select("doc_id", "lang", "grade", "clamped", F.coalesce("said", F.lit(mean)).alias("said"), F.lit(float(moved)).alias("residual"), F.lit(done).alias("rounds"))


def _cut_points(values: DataFrame) -> dict[str, tuple[float, float]]:
    """Per language (and under '' for all) the values between levels 1 and 2, and 2 and 3; at most 3 rows a language are collected."""
    graded = values.filter("clamped").select("lang", F.round("grade").cast("int").alias("level"), "said")
    rows = graded.unionByName(graded.withColumn("lang", F.lit(""))).groupBy("lang", "level").agg(F.percentile_approx("said", 0.5).alias("m")).collect()
    medians = {(r["lang"], r["level"]): r["m"] for r in rows}
    default = (1.5, 2.5)
    cuts = {}
    for lang in ["", *sorted({r["lang"] for r in rows} - {""})]:
        m = [medians.get((lang, level)) for level in LEVELS]
        back = cuts.get("", default)
        cuts[lang] = tuple((m[i] + m[i + 1]) / 2 if m[i] is not None and m[i + 1] is not None else back[i] for i in (0, 1))
    return cuts


def reading_levels(documents: DataFrame, grades: DataFrame, **options) -> DataFrame:
    """doc_id, lang, score, level, residual, rounds (level 1 easy, 2 ordinary, 3 demanding) of every document that ``difficulty`` covers."""
    values = cut_lineage(difficulty(documents, grades, **options))
    cuts = _cut_points(values)
    level = F.lit(None)
    for lang, (a, b) in cuts.items():
        own = F.when(F.col("said") <= a, 1).when(F.col("said") <= b, 2).otherwise(3)
        level = F.when(F.col("lang") == lang, own).otherwise(level) if lang else own
    return values.select("doc_id", "lang", F.col("said").alias("score"), level.cast("int").alias("level"), "residual", "rounds")
