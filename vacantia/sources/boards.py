"""Postings of five kinds of feeds as rows of the posting contract, from Parquet, JSON or XML.

Each mapping takes a frame of envelopes and gives typed columns; the filters that all boards share (allowed
countries, keywords, an id, a web address) are applied by ``kept``. Element order within an envelope is kept in
``_ord`` for keep-first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacantia.functions import jsonshape as js
from vacantia.functions import lookup, text
from vacantia.operators.normalise import keep_first
from vacantia.runtime import once, strip_blanks
from vacantia.schemas import POSTING
from vacantia.sources import live
from vacantia.sources.registry import OWN, SOURCE, Option, Registry


def _posting(df: DataFrame, **values: Column) -> DataFrame:
    return df.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in POSTING], values["external_id"].cast("string").alias("_external_id"), values.get("ord", F.lit(0)).alias("_ord"))


def _somewhere(*places: Column) -> Column:
    return F.coalesce(*[F.nullif(strip_blanks(p), F.lit("")) for p in places])


def _placed(df: DataFrame, place: Column, allowed: list[str]) -> tuple[DataFrame, Column, Column, Column]:
    """``df`` with its place read once, and the place, country and remoteness that come of it."""
    df = once(df, "_place", place)
    country, remote = text.match_country(F.col("_place"), allowed)
    df = once(df, "_match", F.struct(country.alias("country"), remote.alias("remote")))
    return df, F.col("_place"), F.col("_match.country"), F.col("_match.remote")


def search_pages(pages: DataFrame, now: Column, country: Column) -> DataFrame:
    """Pages of a job search: results[] with nested company and place; pay per year; '0', '1' flags imputed pay."""
    r = pages.select(country.alias("_country"), F.posexplode("results").alias("_i", "r")).filter("r IS NOT NULL")
    c = lambda n: F.col(f"r.{n}")
    return _posting(
        r, external_id=c("id"), ord=F.col("_i"), posting_id=text.posting_id("adzuna", c("id")), source=F.lit("adzuna"), title=strip_blanks(c("title")), company=c("company.display_name"), location_raw=c("location.display_name"),
        country=F.upper("_country"), salary_min_eur=c("salary_min"), salary_max_eur=c("salary_max"), salary_period=F.lit("annual"), salary_annual_eur_p50=(c("salary_min") + c("salary_max")) / 2,
        salary_imputed=text.flag(c("salary_is_predicted")), posted_at=F.try_to_timestamp(strip_blanks(c("created"))), ingested_at=now, posting_url=c("redirect_url"), raw_payload=F.to_json("r"),
    )


def intercom_board(boards: DataFrame, now: Column, allowed: list[str]) -> DataFrame:
    """Board envelopes jobs[] with offices: the place is the job's, else the first office's place, else its name."""
    j = boards.select("slug", F.posexplode("jobs").alias("_i", "j")).filter("j IS NOT NULL")
    c = lambda n: F.col(f"j.{n}")
    office = F.get(c("offices"), F.lit(0))
    j, place, country, remote = _placed(j, _somewhere(c("location.name"), office["location"], office["name"]), allowed)
    return _posting(
        j, external_id=c("id"), ord=F.col("_i"), posting_id=text.posting_id("greenhouse", F.col("slug"), c("id")), source=F.lit("greenhouse"), title=c("title"), company=F.col("slug"), location_raw=place, country=country, remote=remote,
        posted_at=F.coalesce(F.try_to_timestamp(strip_blanks(c("updated_at"))), now), ingested_at=now, posting_url=c("absolute_url"), raw_payload=F.to_json("j"),
    )


def palantir_postings(rows: DataFrame, now: Column, allowed: list[str]) -> DataFrame:
    """A bare list of postings; creation times come as milliseconds or ISO text, the link may be the one to apply."""
    x, place, country, remote = _placed(rows, F.col("categories.location"), allowed)
    url = F.coalesce(F.nullif(F.col("hostedUrl"), F.lit("")), F.col("applyUrl"))
    return _posting(
        x, external_id=F.col("id"), posting_id=text.posting_id("lever", F.col("slug"), F.col("id")), source=F.lit("lever"), title=F.col("text"), company=F.col("slug"), location_raw=place, country=country, remote=remote,
        posted_at=text.moment(F.col("createdAt"), now), ingested_at=now, posting_url=url, raw_payload=F.to_json(F.struct(*[c for c in rows.columns if c != "slug"])),
    )


def first_pay(tiers: Column, currency: Column) -> Column:
    """Of a posting's pay tiers (VARIANT) the first salary in the country's currency with a known interval and both bounds,
    as struct<low, high> per year; null if there is none."""
    parts = F.flatten(F.transform(js.items(tiers), lambda t: js.items(js.member(t, "components"))))
    read = F.transform(parts, lambda p: F.struct(
        F.lower(F.trim(js.text(p, "componentType"))).alias("kind"), F.upper(js.text(p, "currencyCode")).alias("currency"), lookup.looked_up(lookup.period_of(js.text(p, "interval")), lookup.PER_YEAR).alias("factor"),
        js.text(p, "minValue").try_cast("double").alias("low"), js.text(p, "maxValue").try_cast("double").alias("high"),
    ))
    fit = F.filter(read, lambda p: p["kind"].isin("salary", "base salary") & (p["currency"] == currency) & p["factor"].isNotNull() & p["low"].isNotNull() & p["high"].isNotNull())
    return F.get(F.transform(fit, lambda p: F.struct((p["low"] * p["factor"]).alias("low"), (p["high"] * p["factor"]).alias("high"))), F.lit(0))


def notion_board(boards: DataFrame, now: Column, allowed: list[str], with_pay: bool = True) -> DataFrame:
    """Board envelopes as JSON text, with pay tiers; remote if the job says so or its place does."""
    j = boards.select("slug", F.posexplode(js.items(js.member(js.parse(F.col("payload")), "jobs"))).alias("_i", "j")).filter(js.is_object(F.col("j")))
    c = lambda n: js.text(F.col("j"), n)
    j, place, country, remote = _placed(j, _somewhere(c("location"), c("locationName")), allowed)
    pay = first_pay(js.member(js.unwrap(js.member(F.col("j"), "compensation")), "compensationTiers"), lookup.currency_of(country)) if with_pay else F.lit(None).cast("struct<low:double,high:double>")
    j = once(j, "_pay", pay)
    low, high = F.col("_pay.low"), F.col("_pay.high")
    return _posting(
        j, external_id=c("id"), ord=F.col("_i"), posting_id=text.posting_id("ashby", F.col("slug"), c("id")), source=F.lit("ashby"), title=c("title"), company=F.col("slug"), location_raw=place, country=country,
        remote=F.coalesce(F.try_variant_get("j", "$.isRemote", "boolean"), F.lit(False)) | remote, salary_min_eur=low, salary_max_eur=high, salary_period=F.when(low.isNotNull(), "annual"),
        salary_annual_eur_p50=(low + high) / 2, salary_imputed=F.when(low.isNotNull(), F.lit(False)), posted_at=F.coalesce(F.try_to_timestamp(strip_blanks(c("publishedAt"))), F.try_to_timestamp(strip_blanks(c("updatedAt"))), now),
        ingested_at=now, posting_url=c("jobUrl"), raw_payload=F.to_json("j"),
    )


_POSITION = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "subcompany", "office", "department", "recruitingCategory", "name", "employmentType", "seniority", "schedule", "yearsOfExperience", "occupation", "occupationCategory", "createDate")])


def personio_positions(spark: SparkSession, path: str) -> DataFrame:
    """The positions of XML feeds at ``path``; malformed files give none, missing elements are null."""
    return spark.read.format("xml").option("rowTag", "position").option("mode", "PERMISSIVE").schema(_POSITION).load(path)


def personio_feed(positions: DataFrame, slug: Column, now: Column, allowed: list[str]) -> DataFrame:
    """Positions of an XML feed; their address is made from slug and id; positions without name are dropped."""
    named = positions.filter(strip_blanks(F.coalesce("name", F.lit(""))) != "").withColumn("_slug", slug)
    x, place, country, remote = _placed(named, F.col("office"), allowed)
    return _posting(
        x, external_id=F.col("id"), posting_id=text.posting_id("personio", F.col("_slug"), F.col("id")), source=F.lit("personio"), title=F.col("name"), company=F.coalesce("subcompany", "_slug"), location_raw=place, country=country, remote=remote,
        posted_at=F.coalesce(F.try_to_timestamp("createDate"), now), ingested_at=now, posting_url=F.concat(F.lit("https://"), F.col("_slug"), F.lit(".jobs.personio.de/job/"), F.col("id")), raw_payload=F.to_json(F.struct(*_POSITION.names)),
    )


def kept(rows: DataFrame, keywords: list[str] = (), most: int | None = None) -> DataFrame:
    """What every feed keeps: rows with an id, an allowed country, a keyword in the title and a web address; the first
    of each posting_id in the feed's order; ``most`` at most if given (the adapters' max_results)."""
    live = rows.filter((strip_blanks(F.coalesce("_external_id", F.lit(""))) != "") & F.col("country").isNotNull() & F.coalesce(F.col("posting_url").startswith("http"), F.lit(False)) & text.has_keyword(F.col("title"), list(keywords)))
    first = keep_first(live, F.col("posting_id"), F.col("_ord"), F.col("posted_at"), F.col("raw_payload"))
    if most is not None:
        first = first.orderBy("_ord", "posting_id").limit(most)
    return first.drop("_external_id", "_ord")


def united(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by name; columns that a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


#: Feeds by name.
ADAPTERS = Registry()
register = ADAPTERS.register

_BOARD = SOURCE | OWN | {"companies_file": Option(str), "timeout_seconds": Option(float, 30.0, above=0)}
_SEARCH = SOURCE | OWN | {
    "results_per_page": Option(int, 50, least=1, most=50), "max_pages": Option(int, 5, least=1, most=20), "timeout_seconds": Option(float, 30.0, above=0),
    "max_days_old": Option(int, None, least=1), "min_interval_hours": Option(int, 24, least=0),
}


def _now(config: dict) -> Column:
    return F.lit(config["now"]).cast("timestamp") if config["now"] else F.current_timestamp()


def _texts(spark: SparkSession, kind: str, config: dict) -> DataFrame:
    """slug and body of a feed: of the files at ``path``, of which each is one envelope, or of its endpoints."""
    if not config["path"]:
        return live.answers(spark, kind, config).select("slug", "body")
    return spark.read.text(config["path"], wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/_.]+)\.\w+$", 1).alias("slug"), F.col("value").alias("body"))


def _envelopes(spark: SparkSession, kind: str, config: dict, schema: str) -> DataFrame:
    """The envelopes of a feed, typed: a Parquet folder's, or the texts' as JSON; texts that are none give null members."""
    if (config["path"] or "").endswith(".parquet"):
        return spark.read.parquet(config["path"])
    return _texts(spark, kind, config).select("slug", F.from_json("body", schema).alias("e")).select("slug", "e.*")


def _kept(rows: DataFrame, config: dict, keywords: bool = True) -> DataFrame:
    return kept(rows, config["keywords"] if keywords else [], config["max_results"])


_JOB = "id bigint, title string, absolute_url string, location struct<name string>, updated_at string, offices array<struct<id bigint, name string, location string>>, departments array<struct<id bigint, name string>>, content string"
_RESULT = "id string, title string, description string, company struct<display_name string>, location struct<area array<string>, display_name string>, salary_min double, salary_max double, salary_is_predicted string, contract_time string, created string, redirect_url string, latitude double, longitude double"
_LISTED = "id string, text string, categories struct<location string, commitment string, team string>, createdAt string, hostedUrl string, applyUrl string, descriptionPlain string"


@register("adzuna", _SEARCH)
def _adzuna(spark: SparkSession, config: dict) -> DataFrame:
    # the search itself looks for the keywords, also in descriptions
    pages = _envelopes(spark, "adzuna", config, f"results array<struct<{_RESULT}>>")
    return _kept(search_pages(pages, _now(config), F.regexp_extract("slug", "([a-z]{2})$", 1)), config, keywords=False)


@register("greenhouse", _BOARD)
def _greenhouse(spark: SparkSession, config: dict) -> DataFrame:
    return _kept(intercom_board(_envelopes(spark, "greenhouse", config, f"jobs array<struct<{_JOB}>>"), _now(config), config["countries"]), config)


@register("lever", _BOARD)
def _lever(spark: SparkSession, config: dict) -> DataFrame:
    if (config["path"] or "").endswith(".parquet"):
        rows = spark.read.parquet(config["path"])
    else:
        rows = _texts(spark, "lever", config).select("slug", F.inline(F.from_json("body", f"array<struct<{_LISTED}>>")))
    return _kept(palantir_postings(rows, _now(config), config["countries"]), config)


@register("ashby", _BOARD | {"include_compensation": Option(bool, True)})
def _ashby(spark: SparkSession, config: dict) -> DataFrame:
    if (config["path"] or "").endswith(".parquet"):
        boards = spark.read.parquet(config["path"])
    else:
        boards = _texts(spark, "ashby", config).withColumnRenamed("body", "payload")
    return _kept(notion_board(boards, _now(config), config["countries"], config["include_compensation"]), config)


@register("personio", _BOARD)
def _personio(spark: SparkSession, config: dict) -> DataFrame:
    if config["path"]:
        positions, slug = personio_positions(spark, config["path"]), F.lit(config["slug"])
    else:
        found = F.from_xml("body", T.StructType([T.StructField("position", T.ArrayType(_POSITION))]))
        positions = live.answers(spark, "personio", config).select("slug", F.explode(found["position"]).alias("p")).select("p.*", F.col("slug").alias("_slug"))
        slug = F.col("_slug")
    return _kept(personio_feed(positions, slug, _now(config), config["countries"]), config)
