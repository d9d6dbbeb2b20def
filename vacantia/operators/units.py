"""Problem 6: salaries recorded in different currencies, periods and scales, in whole euros per year.

What a posting states is read first: the payload's structured compensation or its one expression of pay in
running text, then salary_period, then the currency of the country. What is stated nowhere is decided by the
method named: a mixture on the log scale whose components are one bell curve of yearly euros, shifted by the
logarithms of the known conversion factors. The curve is fitted to all rows, stated ones in their known
component and the others by responsibility; each row takes the unit of greatest posterior, and a posterior
under ``SURE`` is flagged. The same posterior decides whether an abbreviated amount was multiplied out where
the payload gives no number to compare with.

The fit sees a histogram of at most ``BINS`` bins per kind of row, which is all the driver ever receives.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import jsonshape as js
from vacantia.runtime import cut_lineage, once

# How many of each period make a year.
PER_YEAR = {"annual": 1, "monthly": 12, "weekly": 52, "daily": 261, "hourly": 2080}
# The scales in which amounts are recorded, as factors to whole units.
SCALES = {"plain": 1.0, "thousands": 1000.0, "minor": 0.01}
# Signs of currencies; the dollar sign is the country's dollar.
SIGNS = {"€": "EUR", "£": "GBP", "₹": "INR", "zł": "PLN", "kr": "SEK"}
DOLLARS = ("USD", "CAD", "AUD", "SGD", "NZD", "HKD")
# How texts say the period of pay.
PHRASES = {
    "annual": r"per\s+annum|annually|yearly|(?:per|a|an|par|pro|je|each)\s+(?:year|annum|an|année|jahr)|p\.\s?a\.?|/\s?(?:yr|year|jahr|an)",
    "monthly": r"monthly|(?:per|a|par|pro|je|each)\s+(?:month|mois|monat)|p\.?c\.?m\.?|(?:brutto)?/\s?(?:month|mo|monat|mois)",
    "weekly": r"weekly|(?:per|a|par|pro|je|each)\s+(?:week|semaine|woche)|p\.\s?w\.?|/\s?(?:wk|week|woche)",
    "daily": r"daily(?:\s+rate)?|(?:per|a|par|pro|je|each)\s+(?:day|jour|tag)|/\s?(?:day|tag|jour)",
    "hourly": r"hourly|(?:per|an|a|par|pro|je|each)\s+(?:hour|heure|stunde)|de\s+l['’]heure|p/h|/\s?(?:hour|hr|std|h)",
}
# Words of the structured fields.
INTERVALS = {"annual": "year|annual", "monthly": "month", "weekly": "week", "daily": "day|daily", "hourly": "hour"}
THOUSANDS, MINOR = ("thousands", "thousand", "k", "x1000", "1000"), ("minor", "cents", "cent", "1/100")

#: Share of an inferred unit's posterior from which it counts as sure, and the histogram's bins.
SURE, BIN, LOW, BINS = 0.9, 0.02, -12.0, 2000
#: Spread of the logarithm of a recorded number beside the one that a payload gives.
SPREAD = 1.0
#: The greatest yearly amount told; greater ones count as it.
MOST = 9_000_000_000_000_000_000

_CUR = r"(?:EUR|USD|GBP|INR|AUD|CAD|PLN|SEK|CHF|SGD|NOK|DKK|CZK|HUF|NZD|HKD|JPY|€|£|\$|₹|zł|kr)"
_NUM = r"(?:\d{1,3}(?:[ .,'’\x{A0}\x{202F}]\d{3})+(?!\d)(?:[.,]\d{1,2})?|\d+(?:[.,]\d+)?)"
_K = r"(?:k|tsd\.?|thousand|tausend|mille)(?![a-z])"
_DASH = r"(?:-|–|—|to|bis|à)"


def _pay(n: int, head: str, tail: str) -> str:
    period = "|".join(f"(?<{p}{n}>{x})" for p, x in PHRASES.items())
    return rf"{head}(?<lo{n}>{_NUM})\s*(?<ka{n}>{_K})?(?:\s*{_DASH}\s*(?:{_CUR}\s*)?(?<hi{n}>{_NUM})(?:\s*(?<kb{n}>{_K}))?)?\s*{tail}".replace("PERIOD", rf"(?:\s*(?:{period})(?![a-z]))")


def _scaled(n: int) -> str:
    """An amount without currency: a scale word must follow the last number."""
    period = "|".join(f"(?<{p}{n}>{x})" for p, x in PHRASES.items())
    return rf"(?<![\w.,])(?<lo{n}>{_NUM})\s*(?:(?:{_K})?\s*{_DASH}\s*(?<hi{n}>{_NUM})\s*)?(?<ka{n}>{_K})(?<kb{n}>)(?:\s*(?:{period})(?![a-z]))?"


#: An amount counts as pay if it has a currency before, or a currency or scale behind, or a period right behind.
PATTERN = "(?is)^.*?(?:{})".format("|".join([
    _pay(1, rf"(?<cu1>{_CUR})\s*", "PERIOD?"),
    _pay(2, r"(?<![\w.,])", rf"(?<cu2>{_CUR})PERIOD?"),
    _scaled(3),
    _pay(4, r"(?<![\w.,])", "PERIOD"),
])) + ".*$"
_KEYS = ("cu", "lo", "hi", "ka", "kb", *PER_YEAR)
_SEP = "\x1f"
_TEMPLATE = _SEP + _SEP.join("".join("${%s%d}" % (k, n) for n in range(1, 5) if (k, n) not in (("cu", 3), ("cu", 4))) for k in _KEYS)


def _number(s: Column) -> Column:
    """A number as written, blanks, points or commas grouping thousands where three digits follow."""
    bare = F.regexp_replace(s, r"[ '’\x{A0}\x{202F}]", "")
    grouped = F.regexp_replace(bare, r"[.,](?=\d{3}(?:\D|$))", "")
    return F.replace(grouped, F.lit(","), F.lit(".")).try_cast("double")


def _one_of(c: Column, choices: dict[str, str]) -> Column:
    return reduce(lambda acc, kv: acc.when(c.rlike(kv[1]), kv[0]), choices.items(), F.when(F.lit(False), ""))


def stated(postings: DataFrame) -> DataFrame:
    """What each posting's payload says of its pay: text_* of the expression in running text, pay_* structured.

    JSON payloads are read as JSON (texts decoded), XML payloads by their tags. Null or unreadable payloads say
    nothing."""
    raw = F.col("raw_payload")
    x = once(postings, "_v", F.when(~raw.startswith("<"), js.parse(raw)))
    members = F.try_variant_get("_v", "$", "map<string,variant>")
    texts = F.array_join(F.map_values(F.transform_values(F.map_filter(members, lambda k, _: ~k.isin("id", "compensation")), lambda _, v: F.coalesce(F.try_variant_get(v, "$", "string"), F.lit("")))), " ")
    x = once(x, "_text", F.regexp_replace(F.coalesce(texts, F.regexp_replace(raw, r"(?s)<id>.*?</id>|<compensation>.*?</compensation>", " ")), r"<[^>]*>", " "))
    pay = js.unwrap(js.member(F.col("_v"), "compensation"))
    tiers = js.items(js.member(pay, "compensationTiers"))
    parts = F.flatten(F.transform(tiers, lambda t: js.items(js.member(t, "components"))))
    own = F.filter(F.concat(parts, js.items(pay)), lambda c: js.is_object(c) & F.coalesce(js.text(c, "componentType"), F.lit("Salary")).rlike("(?i)salary") & js.text(c, "interval").isNotNull())
    x = once(x, "_c", F.get(own, F.lit(0)))

    def field(name: str) -> Column:
        return F.coalesce(js.text(F.col("_c"), name), F.nullif(F.regexp_extract(raw, rf"<{name}>([^<]*)</{name}>", 1), F.lit("")))

    x = once(x, "_p", F.struct(F.lower(field("interval")).alias("interval"), F.upper(F.trim(field("currencyCode"))).alias("currency"), field("minValue").try_cast("double").alias("low"), field("maxValue").try_cast("double").alias("high"), F.lower(F.trim(field("valueUnit"))).alias("unit")))
    x = once(x, "_t", F.split(F.regexp_replace("_text", PATTERN, _TEMPLATE), _SEP))
    part = {k: F.nullif(F.when(F.get("_t", F.lit(0)) == "", F.get("_t", F.lit(n + 1))), F.lit("")) for n, k in enumerate(_KEYS)}
    return once(x, "_s", F.struct(*[c.alias(k) for k, c in part.items()])).drop("_v", "_t", "_c", "_text")


def amounts(postings: DataFrame, rates: DataFrame) -> DataFrame:
    """posting_id, bound, value, ingested_at, period, currency, rate, scale of every recorded bound.

    ``period`` is null where stated nowhere, ``rate`` where the currency is unknown; ``scale`` is the factor to
    whole units and ``sure`` its posterior, both null where the payload abbreviates but gives no number to compare the
    recorded one with."""
    x = stated(postings.select("posting_id", "country", "salary_min_eur", "salary_max_eur", "salary_period", "ingested_at", "raw_payload"))
    by_country = rates.filter("country is not null").groupBy(F.col("country")).agg(F.max("currency").alias("_home"))
    by_currency = rates.filter("currency is not null and rate > 0").groupBy(F.col("currency").alias("currency")).agg(F.max("rate").alias("rate"))
    # one row per country and one per currency of the world: bounded by their lists
    x = x.join(F.broadcast(by_country), "country", "left")
    s, p = {k: F.col(f"_s.{k}") for k in _KEYS}, {k: F.col(f"_p.{k}") for k in ("interval", "currency", "low", "high", "unit")}
    sign = F.lower(s["cu"])
    named = reduce(lambda acc, kv: acc.when(sign == kv[0], kv[1]), SIGNS.items(), F.when(sign == "$", F.when(F.col("_home").isin(*DOLLARS), F.col("_home")).otherwise("USD"))).otherwise(F.upper(s["cu"]))
    period = F.coalesce(_one_of(p["interval"], INTERVALS), *[F.when(s[k].isNotNull(), k) for k in PER_YEAR], F.when(F.col("salary_period").isin(*PER_YEAR), F.col("salary_period")))
    structured = p["interval"].isNotNull()
    unit = F.when(structured & p["unit"].isin(*THOUSANDS), "thousands").when(structured & p["unit"].isin(*MINOR), "minor").when(~structured & (s["ka"].isNotNull() | s["kb"].isNotNull()), "thousands").otherwise("plain")
    low, high = F.when(structured, p["low"]).otherwise(_number(s["lo"])), F.when(structured, p["high"]).otherwise(_number(s["hi"]))
    x = once(x, "_u", F.struct(period.alias("period"), F.coalesce(p["currency"], named, F.col("_home")).alias("currency"), unit.alias("unit"), F.coalesce(low, high).alias("min"), F.coalesce(high, low).alias("max")))
    bounds = F.filter(F.array(*[F.struct(F.lit(b).alias("bound"), F.col(f"salary_{b}_eur").alias("value"), F.col(f"_u.{b}").alias("said")) for b in ("min", "max")]), lambda b: b["value"].isNotNull())
    x = x.select("posting_id", "ingested_at", "_u.period", "_u.currency", "_u.unit", F.explode(bounds).alias("b")).select("posting_id", "ingested_at", "period", "currency", "unit", "b.*")
    # two components of the recorded number beside the said one: as said, or multiplied out
    factor = F.when(F.col("unit") == "thousands", SCALES["thousands"]).when(F.col("unit") == "minor", SCALES["minor"])
    ratio = F.ln(F.when((F.col("value") > 0) & (F.col("said") > 0), F.try_divide("value", "said")))
    odds = (ratio * ratio - (ratio - F.ln(factor)) ** 2) / (2 * SPREAD**2)
    x = once(x, "_out", F.when(F.col("unit") == "plain", 1.0).otherwise(1 / (1 + F.exp(-odds))))
    scale = F.when(F.col("unit") == "plain", 1.0).when(F.col("_out") >= 0.5, 1.0).when(F.col("_out") < 0.5, factor)
    x = x.withColumn("scale", scale).withColumn("sure", F.greatest("_out", 1 - F.col("_out")))
    return x.join(F.broadcast(by_currency), "currency", "left").select("posting_id", "bound", "value", "ingested_at", "period", "currency", "unit", "rate", "scale", "sure")


#: Every (period, scale) an amount may be recorded in, with the factor to yearly whole units.
COMPONENTS = [(p, s, n * f) for p, n in PER_YEAR.items() for s, f in SCALES.items()]


def fit_mixture(rows: DataFrame, rounds: int = 60) -> dict:
    """Centre and width of the yearly logarithm and the weight of each component, by expectation maximisation.

    ``rows`` are ``amounts``. Only positive values with a known currency take part. With none, the centre is
    that of 30,000 euros and all weights are equal."""
    usable = (F.col("value") > 0) & F.col("rate").isNotNull() & (F.col("value") < float("inf"))
    known = F.col("period").isNotNull() & F.col("scale").isNotNull()
    factor = reduce(lambda acc, kv: acc.when(F.col("period") == kv[0], float(kv[1])), PER_YEAR.items(), F.when(F.lit(False), 0.0))
    log = F.ln(F.col("value") / F.col("rate")) + F.when(known, F.ln(factor * F.col("scale"))).otherwise(0.0)
    place = F.least(F.greatest(F.floor((log - LOW) / BIN), F.lit(0)), F.lit(BINS - 1)).cast("int")
    counts = np.zeros((2, BINS))
    for r in rows.filter(usable).groupBy(known.alias("known"), place.alias("bin")).count().collect():
        counts[int(r["known"]), r["bin"]] = r["count"]
    centres = LOW + BIN * (np.arange(BINS) + 0.5)
    shift = np.log([f for _, _, f in COMPONENTS])
    mean, sd, weights = math.log(30_000), 0.6, np.full(len(shift), 1 / len(shift))
    for _ in range(rounds if counts.sum() else 0):
        yearly = centres[:, None] + shift
        dens = weights * np.exp(-0.5 * ((yearly - mean) / sd) ** 2)
        resp = dens / np.maximum(dens.sum(1, keepdims=True), 1e-300)
        # far outliers of either kind are given no say in the curve
        near = np.abs(centres - mean) < 6 * sd
        mass, known_mass = resp * counts[0][:, None] * (np.abs(yearly - mean) < 6 * sd), counts[1] * near
        total = mass.sum() + known_mass.sum()
        if total <= 0:
            break
        mean = float(((mass * yearly).sum() + (known_mass * centres).sum()) / total)
        sd = max(0.05, math.sqrt(float(((mass * (yearly - mean) ** 2).sum() + (known_mass * (centres - mean) ** 2).sum()) / total)))
        weights = (mass.sum(0) + 0.5) / (mass.sum() + 0.5 * len(shift))
    return {"mean": mean, "sd": sd, "weights": [float(w) for w in weights]}


def in_yearly_euros(rows: DataFrame, fit: dict) -> DataFrame:
    """posting_id, bound, value, currency, period, scale, eur_per_year, stated, posterior, uncertain.

    ``stated`` tells whether the period was; else period and scale are those of greatest posterior, and
    ``uncertain`` marks posteriors under ``SURE`` (and amounts that allow none: not positive, or of unknown
    currency, whose ``eur_per_year`` is null if the currency is unknown). Amounts beyond ``MOST`` are told as ``MOST``, infinite ones as null. Of a posting delivered with several
    values, the newest ingested holds."""
    log = F.ln(F.when((F.col("value") > 0) & (F.col("value") < float("inf")), F.col("value") / F.col("rate")))

    def density(factor: float, weight: float) -> Column:
        z = (log + math.log(factor) - fit["mean"]) / fit["sd"]
        return F.lit(weight) * F.exp(-0.5 * z * z)

    scored = F.array(*[F.struct(density(f, w).alias("d"), F.lit(p).alias("period"), F.lit(SCALES[s]).alias("scale")) for (p, s, f), w in zip(COMPONENTS, fit["weights"])])
    # what is stated narrows the components; a stated unit leaves two scales to tell apart
    unit_scale = F.when(F.col("unit") == "thousands", 1000.0).when(F.col("unit") == "minor", 0.01).otherwise(1.0)
    open_rows = F.filter(scored, lambda c: (F.col("period").isNull() | (c["period"] == F.col("period"))) & F.when(F.col("scale").isNotNull() & (F.col("period").isNotNull() | (F.col("unit") != "plain")), c["scale"] == F.col("scale")).when(F.col("unit") != "plain", (c["scale"] == 1.0) | (c["scale"] == unit_scale)).otherwise(F.lit(True)))
    x = once(rows, "_open", F.when(F.col("period").isNull() | F.col("scale").isNull(), open_rows))
    x = once(x, "_best", F.array_max("_open"))
    mass = F.aggregate(F.transform("_open", lambda c: F.coalesce(c["d"], F.lit(0.0))), F.lit(0.0), lambda a, b: a + b)
    stated_period = F.col("period").isNotNull()
    sure = F.col("_open").isNull()
    posterior = F.when(sure, F.coalesce("sure", F.lit(1.0))).otherwise(F.try_divide(F.col("_best.d"), mass))
    period = F.coalesce("period", "_best.period")
    scale = F.coalesce(F.when(sure, F.col("scale")), F.col("_best.scale"))
    factor = reduce(lambda acc, kv: acc.when(period == kv[0], float(kv[1])), PER_YEAR.items(), F.when(F.lit(False), 0.0))
    euros = F.col("value") * scale * factor / F.col("rate") + 0.5
    whole = F.when(euros.isNull() | F.isnan(euros) | (F.abs(euros) == float("inf")), None).when(euros >= MOST, MOST).when(euros <= -MOST, -MOST).otherwise(F.floor(euros)).cast("long")
    out = x.select(
        "posting_id", "bound", "ingested_at",
        F.struct("value", "currency", period.alias("period"), scale.alias("scale"), whole.alias("eur_per_year"), stated_period.alias("stated"), posterior.alias("posterior"), F.coalesce(posterior < SURE, F.lit(True)).alias("uncertain")).alias("r"),
    )
    return out.filter("posting_id is not null").groupBy("posting_id", "bound").agg(F.max(F.struct("ingested_at", "r")).alias("m")).select("posting_id", "bound", "m.r.*")


def salary_units(postings: DataFrame, rates: DataFrame) -> DataFrame:
    """``in_yearly_euros`` of all recorded bounds, fitted on the same rows. Empty tables give no rows."""
    rows = cut_lineage(amounts(postings, rates))
    return in_yearly_euros(rows, fit_mixture(rows))
