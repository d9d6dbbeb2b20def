"""Queries of the job-market pipeline and dashboard over the tables of a data folder, with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia import schemas
from vacantia.functions import lookup, text
from vacantia.operators import cube, dashboard, normalise, similarity
from vacantia.operators.quantile import exact_quantile
from vacantia.runtime import once, table
from vacantia.sources import boards, statistics
from vacantia.sources import labels as label_list

NOW = "2025-10-01 00:00:00"
ALLOWED = ["ie", "gb", "de", "fr", "nl", "se", "remote-europe"]
KEYWORDS = ["analyst", "engineer", "nurse"]
SKILLS = ["calm", "planning tools", "partners", "rota", "operations unit"]
#: The dashboard's default filter with a country and a first day.
CHOSEN = {"country": "IE", "low": 0.0, "high": 250_000.0, "since": "2025-01-01"}


def postings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "postings")


def dash(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.extract(postings(spark, d))


def rates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "fx_rates").select("currency", "rate")


def labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "isco_labels")


def _chosen(spark, d):
    return dash(spark, d).filter(dashboard.where(**CHOSEN))


def fx_convert(spark, d):
    """The three salaries in euros."""
    return normalise.to_euros(postings(spark, d), rates(spark, d)).select("posting_id", *normalise.SALARIES)


def fx_unresolved(spark, d):
    """Currencies without rate and the rows that have them."""
    few = rates(spark, d).filter("currency IN ('EUR', 'GBP')")
    return normalise.unresolved(postings(spark, d), few)


def midpoint(spark, d):
    """C13."""
    return normalise.with_midpoint(postings(spark, d)).select("posting_id", "salary_annual_eur_p50")


def recency_floor(spark, d):
    """D6, K1."""
    return normalise.recent(postings(spark, d), F.lit(NOW).cast("timestamp"), 180).select("posting_id", "posted_at")


def normalised(spark, d):
    """3.2 end to end without tagging: euros, midpoint, recency, first of each duplicate."""
    x = normalise.with_midpoint(normalise.to_euros(postings(spark, d), rates(spark, d)))
    x = normalise.without_duplicates(normalise.recent(x, F.lit(NOW).cast("timestamp"), 180), F.col("ingested_at"), F.col("posting_id"))
    return x.select("posting_id", "posting_url", "salary_annual_eur_p50")


def benchmark_fx(spark, d):
    """Benchmark pay in euros, rows without rate dropped. The benchmark is the postings' median by code and country."""
    return normalise.benchmarks_to_euros(_benchmark(spark, d), rates(spark, d).filter("currency <> 'SGD'")).select("isco_code", "country", "currency", "median_eur")


def _benchmark(spark, d):
    x = exact_quantile(postings(spark, d).filter("isco_code IS NOT NULL"), ["isco_code", "country"], "salary_annual_eur_p50", 0.5, "median_eur").drop("n")
    none = F.lit(None).cast("double")
    x = x.withColumns({"period": F.lit("2025"), "currency": lookup.currency_of(F.col("country")), "p25_eur": none, "p75_eur": none, "n_observations": F.lit(None).cast("bigint"), "source": F.lit("own"), "source_url": F.lit("https://benchmark.example"), "retrieved_at": F.lit(NOW).cast("timestamp")})
    return x.select(schemas.BENCHMARK.names)


def benchmark_overlay(spark, d):
    """Postings beside the benchmark of their code and country."""
    return normalise.overlay(postings(spark, d), _benchmark(spark, d), ["own"]).select("posting_id", "isco_code", "country", "own_median_eur")


def year_month(spark, d):
    """C14, J13."""
    return postings(spark, d).select("posting_id", text.year_month(F.col("posted_at")).alias("year_month"))


def dashboard_extract(spark, d):
    """A19, B9, C15, C16, D7."""
    return dash(spark, d)


def filter_global(spark, d):
    """D8, D9, J21."""
    return _chosen(spark, d).filter("isco_major = '1'").select("title", "company", "salary_annual_eur_p50")


def distinct_country(spark, d):
    return dashboard.distinct_values(dash(spark, d), "country")


def distinct_major(spark, d):
    return dashboard.distinct_values(dash(spark, d), "isco_major")


def date_span(spark, d):
    return dashboard.date_span(dash(spark, d))


def live_kpi(spark, d):
    return dashboard.key_figures(dash(spark, d))


def salary_rows(spark, d):
    return dashboard.salaries(dash(spark, d))


def salary_histogram(spark, d):
    return dashboard.histogram(dash(spark, d), 0.0, 240_000.0, 24)


def median_by_country(spark, d):
    return dashboard.median_by_country(dash(spark, d).filter(dashboard.where(low=0.0, high=250_000.0)))


def top_titles(spark, d):
    return dashboard.top_titles(dash(spark, d))


def isco_mix(spark, d):
    return dashboard.major_mix(dash(spark, d))


def isco_labelled(spark, d):
    """The mix with the groups' names."""
    return dash(spark, d).groupBy("isco_major").agg(F.count("*").alias("n")).select(lookup.major_label(F.col("isco_major")).alias("major"), "n")


def heatmap_having(spark, d):
    return dashboard.heatmap(dash(spark, d))


def weekly_cadence(spark, d):
    return dashboard.weekly_cadence(dash(spark, d))


def source_counts(spark, d):
    return dashboard.source_counts(dash(spark, d))


def coverage(spark, d):
    """F20, F21."""
    return dashboard.coverage(dash(spark, d))


def manifest_counts(spark, d):
    """counts by source, country and method in one pass."""
    return dashboard.counts_by_kind(postings(spark, d), ["source", "country", "isco_match_method"])


def match_rate(spark, d):
    """F14."""
    return normalise.match_rate(postings(spark, d))


def validate_counts(spark, d):
    """Rows that break each rule of the posting contract."""
    return schemas.violations(postings(spark, d), schemas.POSTINGS)


def canonical_url(spark, d):
    """J5, J8."""
    return postings(spark, d).select("posting_id", text.canonical_url(F.col("posting_url")).alias("url"))


def dedupe_keys(spark, d):
    """J6, J7."""
    return postings(spark, d).select("posting_id", text.dedupe_key(F.col("posting_url"), F.col("title"), F.col("company"), F.col("country")).alias("dedupe_key"))


def dedupe_keep_first(spark, d):
    """The first posting of each duplicate key."""
    return normalise.without_duplicates(postings(spark, d).select("posting_id", "posting_url", "title", "company", "country", "ingested_at"), F.col("ingested_at"), F.col("posting_id")).select("posting_id", "ingested_at")


def keep_first_id(spark, d):
    """G1: the first delivery of each posting_id."""
    return normalise.keep_first(postings(spark, d).select("posting_id", "title", "ingested_at"), F.col("posting_id"), F.col("ingested_at"), F.col("title"))


def posting_id_sha1(spark, d):
    """C10."""
    return table(spark, d, "postings_palantir").select("id", "slug", text.posting_id("lever", F.col("slug"), F.col("id")).alias("posting_id"))


def title_clean(spark, d):
    """J2, D19."""
    return postings(spark, d).select("posting_id", text.clean_title(F.col("title")).alias("title"))


def keyword_filter(spark, d):
    """D2."""
    return postings(spark, d).filter(text.has_keyword(F.col("title"), KEYWORDS)).select("posting_id", "title")


def match_country(spark, d):
    """D1, J9."""
    country, remote = text.match_country(F.col("location_raw"), ALLOWED)
    return postings(spark, d).select("posting_id", "location_raw", country.alias("matched"), remote.alias("remote"))


def token_subset_match(spark, d):
    """E4, first stage: titles and labels of which one holds all words of the other."""
    titles = postings(spark, d).select(text.clean_title(F.col("title")).alias("key")).filter("key <> ''").distinct()
    listed = similarity.numbered_labels(labels(spark, d))
    return similarity.subset_matches(titles, listed).join(listed.select("label_idx", "label"), "label_idx").select("key", "label")


def fuzzy_match_top1(spark, d):
    """The best label of each distinct title, cutoff 85."""
    return similarity.best_labels(postings(spark, d).select("title").distinct(), labels(spark, d)).select("title", "isco_code", "label", F.round(F.col("score") / 100, 4).alias("score"))


def label_order(spark, d):
    """Labels deduplicated and numbered in the order that decides ties."""
    return similarity.numbered_labels(labels(spark, d)).select("isco_code", "label", F.col("label_idx").cast("bigint").alias("label_idx"))


def label_stats(spark, d):
    """F18, A12, M7."""
    return labels(spark, d).agg(F.count("*").alias("n_labels"), F.count_distinct("isco_code").alias("n_codes"), F.count_if(F.col("label_kind") == "preferred").alias("n_preferred"), F.count_if(~F.col("isco_code").rlike("^[0-9]{4}$")).alias("n_bad"))


def wage_buckets(spark, d):
    """E5."""
    return labels(spark, d).select("isco_code").distinct().select("isco_code", lookup.wage_bucket(F.col("isco_code")).alias("bucket"))


def _posted():
    """When a posting was published, as seconds since 1970."""
    return F.unix_seconds("posted_at").alias("posted_s")


def search_rows(spark, d):
    """A1, C1, C2, J10."""
    r = boards.search_pages(table(spark, d, "search_page1"), F.lit(NOW).cast("timestamp"), F.regexp_extract("slug", "([a-z]{2})$", 1))
    return boards.kept(r).select("posting_id", "title", "company", "country", "salary_min_eur", "salary_annual_eur_p50", "salary_imputed", "posting_url", _posted())


def intercom_rows(spark, d):
    """A3, C3, D3, D4, G1."""
    r = boards.intercom_board(table(spark, d, "board_intercom"), F.lit(NOW).cast("timestamp"), ALLOWED)
    return boards.kept(r, KEYWORDS).select("posting_id", "title", "location_raw", "country", "remote", "posting_url", _posted())


def palantir_rows(spark, d):
    """A4, C4."""
    r = boards.palantir_postings(table(spark, d, "postings_palantir"), F.lit(NOW).cast("timestamp"), ALLOWED)
    return boards.kept(r).select("posting_id", "title", "location_raw", "country", "remote", "posting_url", _posted())


def notion_rows(spark, d):
    """A5, C5, C6, C7, C8, G5."""
    r = boards.notion_board(table(spark, d, "board_notion"), F.lit(NOW).cast("timestamp"), ALLOWED)
    return boards.kept(r).select("posting_id", "title", "country", "remote", "salary_min_eur", "salary_max_eur", "salary_imputed", _posted())


def union_by_name(spark, d):
    """Postings of two sources, columns aligned by name, what one lacks null."""
    a = table(spark, d, "postings_palantir").select("slug", F.col("text").alias("title"), F.col("hostedUrl").alias("url"))
    b = table(spark, d, "board_intercom").select("slug", F.explode("jobs").alias("j")).select("slug", F.col("j.title").alias("title"), F.col("j.location.name").alias("place"))
    return boards.united([a, b])


def redaction(spark, d):
    """J20, M9."""
    url = F.concat(F.col("posting_url"), F.lit("&app_id=abc&APP_KEY=x'y"))
    return postings(spark, d).select("posting_id", text.redacted(url).alias("url"))


def _jsonstat(cells: DataFrame, dims: dict[str, str], value: str) -> DataFrame:
    """text: ``cells`` as one JSON-stat document, with ``dims`` naming the column of each dimension.

    One row holds the whole cube: as many cells as its dimensions' codes allow, whatever the rows they were made from."""
    cols = list(dims.values())
    codes = cells.agg(*[F.sort_array(F.collect_set(c)).alias(f"_{c}") for c in cols])
    # one row
    flat = cells.join(F.broadcast(codes), F.size(f"_{cols[0]}") > 0)
    pos = F.lit(0)
    for c in cols:
        pos = pos * F.size(f"_{c}") + F.array_position(f"_{c}", F.col(c)) - 1
    whole = flat.agg(F.map_from_entries(F.collect_list(F.struct(pos.cast("string"), F.col(value).cast("double")))).alias("value"), *[F.first(f"_{c}").alias(f"_{c}") for c in cols])
    dimension = F.struct(*[F.struct(F.struct(F.col(f"_{c}").alias("index")).alias("category")).alias(name) for name, c in dims.items()])
    doc = F.struct(F.array(*[F.lit(n) for n in dims]).alias("id"), F.array(*[F.size(f"_{c}") for c in cols]).alias("size"), dimension.alias("dimension"), "value")
    return whole.select(F.to_json(doc).alias("text"))


def cube_decode(spark, d):
    """Postings by country, major group and year, written as a JSON-stat cube and read again."""
    x = postings(spark, d).filter("isco_code IS NOT NULL").select("country", lookup.major_of(F.col("isco_code")).alias("major"), F.year("posted_at").cast("string").alias("year"))
    counts = x.groupBy("country", "major", "year").agg(F.count("*").alias("n"))
    cells = cube.jsonstat_cells(_jsonstat(counts, {k: k for k in ("country", "major", "year")}, "n"), "text")
    return cells.select(F.col("coords")["country"].alias("country"), F.col("coords")["major"].alias("major"), F.col("coords")["year"].alias("year"), F.col("value").cast("bigint").alias("n"))


def cso_rows(spark, d):
    """Counts by wage bucket and quarter as a cube of weekly wages, for every code of the label list."""
    x = postings(spark, d).filter("isco_code IS NOT NULL AND posted_at IS NOT NULL").select(F.concat(F.year("posted_at"), F.quarter("posted_at")).alias("quarter"), F.coalesce(lookup.wage_bucket(F.col("isco_code")), F.lit("0")).alias("bucket"))
    counts = x.groupBy("quarter", "bucket").agg(F.count("*").alias("n")).withColumns({"statistic": F.lit("EHQ03C02"), "sector": F.lit("-")})
    cells = cube.jsonstat_cells(_jsonstat(counts, {statistics.STATISTIC: "statistic", "TLIST(Q1)": "quarter", statistics.SECTOR: "sector", statistics.BUCKET: "bucket"}, "n"), "text")
    rows = cube.weekly_wages(cells, labels(spark, d), statistics.QUARTER, (statistics.SECTOR, "-"), statistics.BUCKET, (statistics.STATISTIC, "EHQ03C02"), "https://cube.example", NOW)
    return rows.select("isco_code", "country", "period", "currency", "median_eur", "source")


def eurostat_rows(spark, d):
    """Counts by code, country and year as a cube of yearly pay, for the allowed countries."""
    x = postings(spark, d).filter("isco_code IS NOT NULL AND posted_at IS NOT NULL").select(F.concat(F.lit("OC"), "isco_code").alias("code"), F.lower("country").alias("geo"), F.year("posted_at").cast("string").alias("time"))
    cells = cube.jsonstat_cells(_jsonstat(x.groupBy("code", "geo", "time").agg(F.count("*").alias("n")), {"isco08": "code", "geo": "geo", "time": "time"}, "n"), "text")
    rows = cube.yearly_pay(cells, [], [c for c in ALLOWED if len(c) == 2], "isco08", "geo", "time", "https://cube.example", NOW)
    return rows.select("isco_code", "country", "period", "currency", "median_eur", "source")


def oecd_rows(spark, d):
    """Counts by code, country and year as SDMX observations with currencies, brought to euros."""
    x = postings(spark, d).filter("isco_code IS NOT NULL AND posted_at IS NOT NULL AND country IS NOT NULL").select("isco_code", "country", F.year("posted_at").cast("string").alias("year"), lookup.currency_of(F.col("country")).alias("currency"))
    counts = x.filter("currency IS NOT NULL").groupBy("isco_code", "country", "year", "currency").agg(F.count("*").alias("n"))
    cols = {"ISCO08": "isco_code", "REF_AREA": "country", "TIME_PERIOD": "year", "UNIT_MEASURE": "currency"}
    codes = counts.agg(*[F.sort_array(F.collect_set(c)).alias(f"_{c}") for c in cols.values()])
    at = {c: F.array_position(f"_{c}", F.col(c)) - 1 for c in cols.values()}
    # one row, as in _jsonstat
    flat = counts.join(F.broadcast(codes), F.size("_year") > 0)
    seen = F.map_from_entries(F.collect_list(F.struct(F.concat_ws(":", at["isco_code"], at["country"], at["year"]), F.array(F.col("n").cast("double"), at["currency"].cast("double")))))
    whole = flat.agg(seen.alias("observations"), *[F.first(f"_{c}").alias(f"_{c}") for c in cols.values()])

    def listed(names: list[str]):
        return F.struct(F.array(*[F.struct(F.lit(n).alias("id"), F.transform(f"_{cols[n]}", lambda v: F.struct(v.alias("id"))).alias("values")) for n in names]).alias("observation"))

    structure = F.struct(listed(["ISCO08", "REF_AREA", "TIME_PERIOD"]).alias("dimensions"), listed(["UNIT_MEASURE"]).alias("attributes"))
    doc = F.struct(F.struct(F.array(structure).alias("structures"), F.array(F.struct("observations")).alias("dataSets")).alias("data"))
    observed = cube.observed_pay(cube.sdmx_observations(whole.select(F.to_json(doc).alias("text")), "text"), [], [], "https://cube.example", NOW)
    return normalise.benchmarks_to_euros(observed, rates(spark, d)).select("isco_code", "country", "period", "currency", F.round("median_eur", 6).alias("median_eur"), "source")


def history_first_last_seen(spark, d):
    """When each posting was first and last seen in the snapshots."""
    rows = table(spark, d, "posting_snapshots").select("posting_id", "delivered_at", "title", "country")
    return dashboard.accumulated(rows, "posting_id", "delivered_at")


def closed_postings(spark, d):
    """Postings last delivered before the day of the newest snapshot."""
    newest = table(spark, d, "posting_snapshots").agg(F.max("snapshot_date").cast("timestamp"))
    return dashboard.closed(history_first_last_seen(spark, d), newest.scalar()).select("posting_id")


def new_since_previous(spark, d):
    """Postings of the newest snapshot that the one before lacks."""
    rows = table(spark, d, "posting_snapshots").select("snapshot_date", "posting_id")
    newest = rows.agg(F.max("snapshot_date")).scalar()
    before = rows.filter(F.col("snapshot_date") < newest).agg(F.max("snapshot_date")).scalar()
    return dashboard.new_since(rows.filter(F.col("snapshot_date") == newest), rows.filter(F.col("snapshot_date") == before), "posting_id").select("posting_id").distinct()


def experience_level(spark, d):
    """P4."""
    return dashboard.with_experience(postings(spark, d)).select("posting_id", "experience_level", "experience_method")


def work_arrangement(spark, d):
    """P5."""
    return dashboard.with_arrangement(postings(spark, d)).select("posting_id", "work_arrangement")


def skill_pay(spark, d):
    """P6, P7."""
    return dashboard.pay_by_skill(dashboard.with_skills(once(postings(spark, d).select("raw_payload", "salary_annual_eur_p50"), "_", F.lit(1)), SKILLS))


def concept_walk(spark, d):
    """The label list as a tree of concepts (digit by digit), walked from its root; the labels at four-digit leaves."""
    x = labels(spark, d).filter("isco_code RLIKE '^[0-9]{4}$' AND label IS NOT NULL")
    uri = lambda n: F.concat(F.lit("https://concepts.example/isco/C"), F.substring("isco_code", 1, n))
    edges = reduce(DataFrame.unionByName, [x.select(uri(n - 1).alias("parent"), uri(n).alias("child")) for n in (1, 2, 3, 4)]).distinct()
    own, more = (x.filter(F.col("label_kind") == kind).select(uri(4).alias(to), F.col("label").alias("title")) for kind, to in (("preferred", "uri"), ("alt", "parent")))
    return label_list.from_concepts(own, edges, more, "https://concepts.example/isco/C")


def prebaked(spark, d):
    """The dashboard's aggregates by country, major group and week in one table."""
    x = dash(spark, d).withColumn("week", text.week(F.col("posted_at")))
    return x.groupBy("country", "isco_major", "week").agg(F.count("*").alias("n"), F.count("salary_annual_eur_p50").alias("n_salary"), F.round(F.sum("salary_annual_eur_p50"), 2).alias("sum_salary"))


QUERIES = {f.__name__: f for f in (
    fx_convert, fx_unresolved, midpoint, recency_floor, normalised, benchmark_fx, benchmark_overlay, year_month, dashboard_extract, filter_global, distinct_country, distinct_major, date_span, live_kpi, salary_rows,
    salary_histogram, median_by_country, top_titles, isco_mix, isco_labelled, heatmap_having, weekly_cadence, source_counts, coverage, manifest_counts, match_rate, validate_counts, canonical_url, dedupe_keys, dedupe_keep_first,
    keep_first_id, posting_id_sha1, title_clean, keyword_filter, match_country, token_subset_match, fuzzy_match_top1, label_order, label_stats, wage_buckets, search_rows, intercom_rows, palantir_rows, notion_rows, union_by_name,
    redaction, cube_decode, cso_rows, eurostat_rows, oecd_rows, history_first_last_seen, closed_postings, new_since_previous, experience_level, work_arrangement, skill_pay, concept_walk, prebaked,
)}
