"""Raw postings to enriched ones: currency, midpoint, recency, occupation, duplicates, contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vacantia import schemas
from vacantia.functions import lookup, text
from vacantia.operators import similarity

SALARIES = ("salary_min_eur", "salary_max_eur", "salary_annual_eur_p50")
PAY = ("median_eur", "p25_eur", "p75_eur")


def with_rate(df: DataFrame, currency: Column, rates: DataFrame) -> DataFrame:
    """``df`` with ``_rate``, units of the currency per euro; null where unknown. EUR is always 1.

    ``rates`` (currency, rate) has one row per currency of the world, so it is broadcast."""
    one = rates.filter("currency IS NOT NULL").groupBy(F.col("currency").alias("_cur")).agg(F.max("rate").alias("_r"))
    joined = df.withColumn("_cur", currency).join(F.broadcast(one), "_cur", "left")
    return joined.withColumn("_rate", F.when(F.col("_cur") == "EUR", 1.0).otherwise(F.col("_r"))).drop("_r")


def to_euros(df: DataFrame, rates: DataFrame) -> DataFrame:
    """The three salaries divided by the rate of the country's currency; null where there is none (or a rate of 0)."""
    x = with_rate(df, lookup.currency_of(F.col("country")), rates)
    return x.withColumns({c: F.try_divide(F.col(c).try_cast("double"), F.col("_rate")) for c in SALARIES}).select(df.columns)


def unresolved(df: DataFrame, rates: DataFrame) -> DataFrame:
    """One row: the sorted countries' currencies without a rate (null currencies as '?'), and how many postings have them."""
    x = with_rate(df, lookup.currency_of(F.col("country")), rates).filter("_rate IS NULL")
    return x.agg(F.array_join(F.sort_array(F.collect_set(F.coalesce("_cur", F.lit("?")))), ",").alias("currencies"), F.count("*").alias("n_rows"))


def with_midpoint(df: DataFrame) -> DataFrame:
    """The yearly figure as the mean of both bounds, null if either is missing."""
    return df.withColumn("salary_annual_eur_p50", (F.col("salary_min_eur") + F.col("salary_max_eur")) / 2)


def recent(df: DataFrame, now: Column, days: int) -> DataFrame:
    """Postings not older than ``days`` before ``now``, the boundary included; those without date are dropped."""
    return df.filter(F.col("posted_at") >= now - F.make_dt_interval(F.lit(days)))


def keep_first(df: DataFrame, key: Column, *order: Column) -> DataFrame:
    """The first row of each key in the given order. Rows with a null key are one group.

    The minimum of the ordered row is taken with a map-side combine, so a hot key is never gathered."""
    cols = df.columns
    row = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], F.struct(*cols).alias("_row"))
    return df.groupBy(key.alias("_key")).agg(F.min(row).alias("_min")).select("_min._row.*")


def keep_first_ranked(df: DataFrame, key: Column, *order: Column) -> DataFrame:
    """The same with a window, for rows that hold types without an order (maps, variants)."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def without_duplicates(df: DataFrame, *order: Column) -> DataFrame:
    """One posting per canonical URL (else title, company and country): the first in the given order."""
    return keep_first(df, text.dedupe_key(F.col("posting_url"), F.col("title"), F.col("company"), F.col("country")), *order)


def tagged(df: DataFrame, labels: DataFrame, cutoff: float = 85.0, classify: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The occupation of each title by token-set similarity: code, method ('fuzzy' or 'none') and score (0 to 1).

    ``classify``, if given, is asked for the titles that no label fits: it takes a frame of distinct titles and gives
    title, isco_code and confidence (0 to 1) of those it knows, which count as method 'llm'."""
    titles = df.select("title").distinct()
    best = similarity.best_labels(titles, labels, cutoff).select("title", "isco_code", F.lit("fuzzy").alias("method"), F.round(F.col("score") / 100, 4).alias("score"))
    if classify is not None:
        said = classify(titles.join(best, "title", "left_anti"))
        best = best.unionByName(said.select("title", "isco_code", F.lit("llm").alias("method"), F.round(F.col("confidence").cast("double"), 4).alias("score")))
    rest = df.drop("isco_code", "isco_match_method", "isco_match_score")
    x = rest.join(best.withColumnRenamed("title", "_t"), F.col("title") == F.col("_t"), "left")
    return x.select(*rest.columns, "isco_code", F.coalesce("method", F.lit("none")).alias("isco_match_method"), F.col("score").alias("isco_match_score"))


def match_rate(df: DataFrame) -> DataFrame:
    """One row: matched, total and the share matched."""
    hit = F.count("isco_code")
    return df.agg(hit.alias("matched"), F.count("*").alias("total"), F.round(F.try_divide(hit, F.count("*")), 6).alias("share"))


def normalise(raw: DataFrame, rates: DataFrame, labels: DataFrame, now: Column, days: int | None, *order: Column) -> DataFrame:
    """All steps in their order; recency comes before tagging and duplicates, so an expired first never hides a fresh one."""
    x = with_midpoint(to_euros(raw, rates))
    if days is not None:
        x = recent(x, now, days)
    x = without_duplicates(tagged(x, labels), *(order or (F.col("ingested_at"), F.col("posting_id"))))
    return schemas.validate(x.select(schemas.POSTING.names), schemas.POSTINGS)


def benchmarks_to_euros(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Benchmark pay divided by the rate of its currency; rows without a rate are dropped, as they can't be compared."""
    x = with_rate(df, F.col("currency"), rates).filter("_rate > 0")
    return x.withColumns({c: F.col(c) / F.col("_rate") for c in PAY}).withColumn("currency", F.lit("EUR")).select(df.columns)


def overlay(postings: DataFrame, benchmarks: DataFrame, sources: list[str]) -> DataFrame:
    """Postings with the benchmark pay of their occupation and country, a column per source.

    Benchmarks are brought to one row per occupation and country first (the newest period of each source), so
    postings are never multiplied. They are official statistics, one row per code, country and source."""
    newest = benchmarks.groupBy("isco_code", "country").pivot("source", sources).agg(F.max_by("median_eur", "period"))
    wide = newest.select("isco_code", "country", *[F.col(f"`{s}`").alias(f"{s}_median_eur") for s in sources])
    return postings.join(wide, ["isco_code", "country"], "left")
