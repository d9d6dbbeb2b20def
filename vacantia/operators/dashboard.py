"""The dashboard's table, its composable filter and its statements, and the tables made from accumulated runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import lookup, text
from vacantia.operators.quantile import exact_quantile

COLUMNS = (
    "title", "company", "country", "posted_at", "posting_url", "salary_annual_eur_p50", "salary_imputed", "salary_period",
    "isco_code", "isco_match_method", "isco_match_score", "isco_major", "source",
)
NO_MAJOR = "∅"


def extract(postings: DataFrame) -> DataFrame:
    """The dashboard's thirteen columns of all postings whose yearly salary is not given or positive."""
    return postings.withColumn("isco_major", lookup.major_of(F.col("isco_code"))).filter("salary_annual_eur_p50 IS NULL OR salary_annual_eur_p50 > 0").select(*COLUMNS)


def where(country: str | None = None, major: str | None = None, low: float | None = None, high: float | None = None, since: str | None = None, until: str | None = None, also: Column | None = None) -> Column:
    """The global filter as one condition; what is None does not filter. Rows without salary pass any salary bound."""
    pay = F.col("salary_annual_eur_p50")
    parts = [
        F.col("country") == country if country else None,
        F.col("isco_major") == major if major else None,
        pay.isNull() | (pay >= low) if low is not None else None,
        pay.isNull() | (pay <= high) if high is not None else None,
        F.col("posted_at") >= F.lit(since).cast("timestamp") if since else None,
        F.col("posted_at") <= F.lit(until).cast("timestamp") if until else None,
        also,
    ]
    return reduce(lambda a, b: a & b, [p for p in parts if p is not None], F.lit(True))


def distinct_values(rows: DataFrame, column: str) -> DataFrame:
    return rows.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def date_span(rows: DataFrame) -> DataFrame:
    return rows.agg(F.min("posted_at").alias("first_posted"), F.max("posted_at").alias("last_posted"))


def key_figures(rows: DataFrame) -> DataFrame:
    return rows.agg(*[F.count(c).cast("int").alias(n) for c, n in (("*", "n_postings"), ("salary_annual_eur_p50", "n_salary"), ("isco_code", "n_isco"))])


def salaries(rows: DataFrame) -> DataFrame:
    return rows.filter("salary_annual_eur_p50 IS NOT NULL").select("salary_annual_eur_p50")


def histogram(rows: DataFrame, low: float, high: float, bins: int) -> DataFrame:
    """bin (0 to bins - 1), n: salaries from ``low`` to below ``high`` in bins of equal width."""
    width = (high - low) / bins
    place = F.floor((F.col("salary_annual_eur_p50") - low) / width).cast("int")
    return rows.filter((F.col("salary_annual_eur_p50") >= low) & (F.col("salary_annual_eur_p50") < high)).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))


def median_by_country(rows: DataFrame) -> DataFrame:
    """country, p50, n: exact medians, highest first; countries without salaries last."""
    live = rows.filter("country IS NOT NULL")
    medians = exact_quantile(live, ["country"], "salary_annual_eur_p50", 0.5)
    every = live.select("country").distinct().join(medians, "country", "left")
    return every.select("country", "p50", F.coalesce("n", F.lit(0)).cast("int").alias("n")).orderBy(F.desc_nulls_last("p50"), "country")


def top_titles(rows: DataFrame, n: int = 15) -> DataFrame:
    """The most frequent titles; of equal counts the first in the alphabet."""
    return rows.filter("title IS NOT NULL").groupBy("title").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "title").limit(n)


def major_mix(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.coalesce("isco_major", F.lit(NO_MAJOR)).alias("isco_major")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "isco_major")


def heatmap(rows: DataFrame, least: int = 3) -> DataFrame:
    """country, isco_major, p50, n of all cells with ``least`` salaries at least."""
    live = rows.filter("country IS NOT NULL AND isco_major IS NOT NULL AND salary_annual_eur_p50 IS NOT NULL")
    cells = exact_quantile(live, ["country", "isco_major"], "salary_annual_eur_p50", 0.5)
    return cells.filter(F.col("n") >= least).withColumn("n", F.col("n").cast("int")).orderBy("country", "isco_major")


def weekly_cadence(rows: DataFrame) -> DataFrame:
    return rows.filter("posted_at IS NOT NULL").groupBy(text.week(F.col("posted_at")).alias("week")).agg(F.count("*").cast("int").alias("n")).orderBy("week")


def source_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source")


def coverage(rows: DataFrame) -> DataFrame:
    """One row: the share of postings with salary, with code, and told by any method, in whole percents; null without postings."""
    def share(hit: Column) -> Column:
        return F.round(100 * F.try_divide(hit, F.count("*"))).cast("int")

    return rows.agg(share(F.count("salary_annual_eur_p50")).alias("pct_salary"), share(F.count("isco_code")).alias("pct_isco"), share(F.count_if(F.coalesce("isco_match_method", F.lit("none")) != "none")).alias("pct_method"))


def counts_by_kind(rows: DataFrame, kinds: list[str]) -> DataFrame:
    """kind, value, n: how often each value of each column occurs, nulls aside, in one pass by grouping sets."""
    live = rows.select(*kinds)
    sets = live.groupingSets([[k] for k in kinds], *kinds).agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    own = {k: (1 << len(kinds)) - 1 - (1 << (len(kinds) - 1 - i)) for i, k in enumerate(kinds)}
    kind = reduce(lambda acc, kv: acc.when(F.col("g") == kv[1], kv[0]), own.items(), F.when(F.lit(False), ""))
    value = F.coalesce(*[F.when(F.col("g") == g, F.col(k)) for k, g in own.items()])
    return sets.select(kind.alias("kind"), value.alias("value"), "n").filter("value IS NOT NULL")


# Accumulated runs.


def accumulated(snapshots: DataFrame, key: str, at: str) -> DataFrame:
    """One row per key over all runs: when it was first and last seen, and the other columns as last seen.

    Rows equal in time are decided by their greatest values; a null key or time takes no part."""
    rest = [c for c in snapshots.columns if c not in (key, at)]
    live = snapshots.filter(F.col(key).isNotNull() & F.col(at).isNotNull())
    got = live.groupBy(key).agg(F.min(at).alias("first_seen_at"), F.max(at).alias("last_seen_at"), F.max(F.struct(at, *rest)).alias("_last"))
    return got.select(key, "first_seen_at", "last_seen_at", *[F.col(f"_last.{c}").alias(c) for c in rest])


def closed(history: DataFrame, generated_at: Column) -> DataFrame:
    """Postings that the newest run no longer saw."""
    return history.filter(F.col("last_seen_at") < generated_at)


def new_since(current: DataFrame, previous: DataFrame, key: str) -> DataFrame:
    """Rows of ``current`` whose key ``previous`` lacks; null keys are new."""
    return current.join(previous.select(key).distinct(), key, "left_anti")


# What titles say of experience and of where work is done, the first that fits.
LEVELS = {"lead": r"\b(lead|principal|head|director|chief|staff)\b", "senior": r"\b(senior|sr|snr)\b", "junior": r"\b(junior|jr|jnr|graduate|grad|intern|trainee|entry)\b", "mid": r"\b(mid|intermediate|experienced)\b"}
ARRANGEMENTS = {"hybrid": r"\bhybrid\b", "remote": r"\b(remote|home office|work from home|wfh|télétravail)\b", "onsite": r"\b(on-?site|in office|office based)\b"}


def _first_told(kinds: dict[str, str], *texts: Column) -> tuple[Column, Column]:
    which = [(i, k, t.rlike("(?i)" + p)) for i, t in enumerate(texts) for k, p in kinds.items()]
    kind = reduce(lambda acc, x: acc.when(x[2], x[1]), which, F.when(F.lit(False), ""))
    place = reduce(lambda acc, x: acc.when(x[2], x[0]), which, F.when(F.lit(False), 0))
    return kind, place


def with_experience(rows: DataFrame) -> DataFrame:
    """experience_level and experience_method: told by the title, else by the payload's text, else null and 'none'."""
    kind, place = _first_told(LEVELS, F.coalesce("title", F.lit("")), F.coalesce("raw_payload", F.lit("")))
    return rows.withColumn("experience_level", kind).withColumn("experience_method", F.coalesce(F.get(F.array(F.lit("title"), F.lit("description")), place), F.lit("none")))


def with_arrangement(rows: DataFrame) -> DataFrame:
    """work_arrangement: remote where the source says so, else told by place, title or payload, else null."""
    kind, _ = _first_told(ARRANGEMENTS, *[F.coalesce(c, F.lit("")) for c in ("location_raw", "title", "raw_payload")])
    return rows.withColumn("work_arrangement", F.when(F.col("remote"), "remote").otherwise(kind))


def with_skills(rows: DataFrame, skills: list[str], most: int = 12) -> DataFrame:
    """skills: those of the list that the payload names as words of their own, in the list's order, ``most`` at most."""
    said = F.lower(F.coalesce("raw_payload", F.lit("")))
    # the plain search spares most texts the pattern
    held = F.array(*[F.when(F.contains(said, F.lit(s.lower())) & said.rlike(rf"(?<![\p{{L}}\p{{N}}])\Q{s.lower()}\E(?![\p{{L}}\p{{N}}])"), s) for s in skills])
    return rows.withColumn("skills", F.slice(F.filter(held, lambda s: s.isNotNull()), 1, most))


def pay_by_skill(rows: DataFrame) -> DataFrame:
    """skill, p50, n: the median yearly salary of the postings that name each skill."""
    each = rows.filter("salary_annual_eur_p50 IS NOT NULL").select(F.explode("skills").alias("skill"), "salary_annual_eur_p50")
    return exact_quantile(each, ["skill"], "salary_annual_eur_p50", 0.5)
