"""Problem 5: timestamps in mixed formats and zones as one UTC instant.

Method: every format is one branch of a single regular expression with named groups. One
``regexp_replace`` per value writes all groups out side by side, so the expression runs once; the parts are
then checked against the calendar and put together by integer day arithmetic. Only wall clock times without
offset need a zone, which Java's rules resolve: a repeated hour is its first pass, a skipped time is read with
the offset before the change. Everything stays in the JVM.
"""

from __future__ import annotations

import zoneinfo
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import jsonshape as js
from vacantia.runtime import once, strip_blanks, table

# Minutes east of UTC of the zone abbreviations read. IST is Irish in zones of Dublin, else Indian.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "EET": 120, "EEST": 180,
    "IST": 330, "SGT": 480, "AWST": 480, "JST": 540, "ACST": 570, "AEST": 600, "ACDT": 630, "AEDT": 660,
    "NZST": 720, "NZDT": 780, "AST": -240, "ADT": -180, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}
# The months, told by their first three letters.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

_NAMES = r"(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_DATES = (
    r"(?<y1>\d{4})-(?<m1>\d{1,2})-(?<d1>\d{1,2})",
    r"(?<y2>\d{4})/(?<m2>\d{1,2})/(?<d2>\d{1,2})",
    r"(?<p3>\d{1,2})[/.](?<q3>\d{1,2})[/.](?<y3>\d{4})",
    r"(?<p4>\d{1,2})-(?<q4>\d{1,2})-(?<y4>\d{4})",
    rf"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+)?(?<d5>\d{{1,2}})(?:st|nd|rd|th)?[ -](?<n5>{_NAMES})\.?,?[ -](?<y5>\d{{4}})",
    rf"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+)?(?<n6>{_NAMES})\.?\s+(?<d6>\d{{1,2}})(?:st|nd|rd|th)?,?\s+(?<y6>\d{{4}})",
)
_CLOCK = r"(?<h1>\d{1,2}):(?<i1>\d{2})(?::(?<s1>\d{2})(?:[.,](?<f1>\d{1,9}))?)?(?:\s*(?<ap>[ap]m))?"
_ZONE = r"(?:\s*(?:(?:utc|gmt)?(?<os>[+-])(?<oh>\d{2})(?::?(?<om>\d{2}))?|(?<ab>[a-z]{1,5})))?\s*(?:\[(?<rg>[a-z_]+(?:/[a-z0-9_+-]+)*)\])?"
_COMPACT = r"(?<y7>\d{4})(?<m7>\d{2})(?<d7>\d{2})T(?<h7>\d{2})(?<i7>\d{2})(?:(?<s7>\d{2})(?:[.,](?<f7>\d{1,9}))?)?"
_NUMBER = r"(?<nu>[+-]?\d{1,18})(?:\.(?<nf>\d{1,18}))?"

#: All formats; case does not count.
PATTERN = rf"(?is)^(?:{_NUMBER}|(?:{_COMPACT}|(?:{'|'.join(_DATES)})(?:(?:T|,?\s+(?:at\s+)?){_CLOCK})?){_ZONE})$"
#: The parts that the pattern yields, each from the groups of whichever branch matched.
PARTS = {
    "nu": ["nu"], "nf": ["nf"], "y": ["y1", "y2", "y3", "y4", "y5", "y6", "y7"], "m": ["m1", "m2", "m7"], "d": ["d1", "d2", "d5", "d6", "d7"],
    "p": ["p3", "p4"], "q": ["q3", "q4"], "n": ["n5", "n6"], "h": ["h1", "h7"], "i": ["i1", "i7"], "s": ["s1", "s7"], "f": ["f1", "f7"],
    "ap": ["ap"], "os": ["os"], "oh": ["oh"], "om": ["om"], "ab": ["ab"], "rg": ["rg"],
}
_SEP = "\x1f"
_TEMPLATE = _SEP + _SEP.join("".join("${%s}" % g for g in groups) for groups in PARTS.values())


def days_from_civil(y: Column, m: Column, d: Column) -> Column:
    """Days from 1970-01-01 to a date of the Gregorian calendar, by integer arithmetic alone."""
    shifted = y - F.when(m <= 2, 1).otherwise(0)
    era = F.floor(shifted / 400)
    of_era = shifted - era * 400
    of_year = F.floor((153 * (m + F.when(m > 2, -3).otherwise(9)) + 2) / 5) + d - 1
    return era * 146097 + of_era * 365 + F.floor(of_era / 4) - F.floor(of_era / 100) + of_year - 719468


def _month_days(y: Column, m: Column) -> Column:
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    return F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)


def with_instant(df: DataFrame, value: str, zone: str, day_first: str, to: str = "epoch_us") -> DataFrame:
    """``df`` with ``to`` (replaced if there): the microseconds since 1970 UTC that the text ``value`` names, null if it names none.

    ``zone`` (IANA) is the zone of values without one and may be null, in which case such values name no instant;
    ``day_first`` says whether all-number dates put the day first (null: month first). A bare number counts
    seconds below 10^11, milliseconds below 10^14, microseconds below 10^17 and is no instant beyond. An offset
    wins over an abbreviation's or region's zone. Digits beyond microseconds are cut. A date alone is the start of
    its day. Null, blank and impossible values (31 November, 25 o'clock, unknown zones) give null."""
    # names that none of the row's columns begins with
    own = "_"
    while any(c.startswith(own) for c in df.columns):
        own += "_"
    x = df.select("*", F.col(value).alias(f"{own}text"), F.col(zone).alias(f"{own}zone"), F.col(day_first).alias(f"{own}first"))
    x = once(x, f"{own}t", F.split(F.regexp_replace(strip_blanks(F.col(f"{own}text")), PATTERN, _TEMPLATE), _SEP))
    # values that do not match are left as they were, without the leading separator
    part = {k: F.nullif(F.when(F.get(f"{own}t", F.lit(0)) == "", F.get(f"{own}t", F.lit(n + 1))), F.lit("")) for n, k in enumerate(PARTS)}
    x = once(x, f"{own}c", F.struct(*[c.alias(k) for k, c in part.items()]))
    c = {k: F.col(f"{own}c.{k}") for k in PARTS}
    whole = {k: c[k].cast("long") for k in ("nu", "y", "m", "d", "p", "q", "h", "i", "s", "oh", "om")}
    named = reduce(lambda acc, k: acc.when(F.lower(F.substring(c["n"], 1, 3)) == MONTHS[k], F.lit(k + 1).cast("long")), range(1, 12), F.when(F.lower(F.substring(c["n"], 1, 3)) == MONTHS[0], F.lit(1).cast("long")))
    first = F.coalesce(F.col(f"{own}first"), F.lit(False))
    known = sorted(zoneinfo.available_timezones() & _java_zones(df))
    minutes = reduce(lambda acc, kv: acc.when(F.upper(c["ab"]) == kv[0], F.lit(kv[1])), ABBREVIATIONS.items(), F.when((F.upper(c["ab"]) == "IST") & (F.col(f"{own}zone") == "Europe/Dublin"), F.lit(60)))
    stated = F.when((whole["oh"] <= 18) & (F.coalesce(whole["om"], F.lit(0)) <= 59), F.when(c["os"] == "-", -1).otherwise(1) * (whole["oh"] * 60 + F.coalesce(whole["om"], F.lit(0))))
    region = F.when(F.lower(c["rg"]).isin("utc", "gmt", "z"), "UTC").when(c["rg"].isin(known), c["rg"])
    x = once(x, f"{own}v", F.struct(
        whole["nu"].alias("number"),
        F.rpad(F.substring(F.coalesce(c["nf"], F.lit("")), 1, 6), 6, "0").cast("long").alias("part"),
        c["nu"].startswith("-").alias("minus"),
        whole["y"].alias("y"),
        F.coalesce(whole["m"], named, F.when(first, whole["q"]).otherwise(whole["p"])).alias("m"),
        F.coalesce(whole["d"], F.when(first, whole["p"]).otherwise(whole["q"])).alias("d"),
        F.coalesce(whole["h"], F.lit(0)).alias("h"), F.coalesce(whole["i"], F.lit(0)).alias("i"), F.coalesce(whole["s"], F.lit(0)).alias("s"),
        F.rpad(F.substring(F.coalesce(c["f"], F.lit("")), 1, 6), 6, "0").cast("long").alias("f"),
        F.lower(c["ap"]).alias("ap"),
        F.when(c["os"].isNotNull(), stated).otherwise(minutes).cast("long").alias("minutes"),
        (c["os"].isNotNull() | c["ab"].isNotNull()).alias("fixed"),
        F.when(c["rg"].isNotNull(), region).otherwise(F.when(F.col(f"{own}zone").isin(known), F.col(f"{own}zone"))).alias("wall"),
    ))
    v = {k: F.col(f"{own}v.{k}") for k in ("number", "part", "minus", "y", "m", "d", "h", "i", "s", "f", "ap", "minutes", "fixed", "wall")}
    sane = (
        (v["y"] >= 1) & v["m"].between(1, 12) & (v["d"] >= 1) & (v["d"] <= _month_days(v["y"], v["m"]))
        & F.when(v["ap"].isNull(), v["h"] <= 23).otherwise(v["h"].between(1, 12)) & (v["i"] <= 59) & (v["s"] <= 59)
    )
    hour = F.when(v["ap"].isNull(), v["h"]).otherwise(v["h"] % 12 + F.when(v["ap"] == "pm", 12).otherwise(0))
    local = (days_from_civil(v["y"], v["m"], v["d"]) * 86400 + (hour * 60 + v["i"]) * 60 + v["s"]) * 1_000_000 + v["f"]
    x = once(x, f"{own}l", F.when(sane, local))
    at = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(F.when(~v["fixed"] & v["wall"].isNotNull(), F.col(f"{own}l"))), F.coalesce(v["wall"], F.lit("UTC"))))
    placed = F.when(v["fixed"], F.col(f"{own}l") - v["minutes"] * 60_000_000).otherwise(at)
    size, sign = F.abs(v["number"]), F.when(v["minus"], -1).otherwise(1)
    number = F.when(size < 10**11, v["number"] * 1_000_000 + sign * v["part"]).when(size < 10**14, v["number"] * 1000 + sign * F.floor(v["part"] / 1000)).when(size < 10**17, v["number"])
    x = once(x, f"{own}us", F.when(v["number"].isNotNull(), number).otherwise(placed))
    return x.select(*[c for c in df.columns if c != to], F.col(f"{own}us").alias(to))


def _java_zones(df: DataFrame) -> set[str]:
    jvm = getattr(df.sparkSession, "_jvm", None)
    return set(jvm.java.time.ZoneId.getAvailableZoneIds()) if jvm is not None else zoneinfo.available_timezones()


def dated_records(spark, d: str) -> DataFrame:
    """source_table, record_id, slug, value of everything dated in the four sources, as delivered."""

    def rows(df: DataFrame, name: str, key: Column, value: Column) -> DataFrame:
        return df.select(F.lit(name).alias("source_table"), key.cast("string").alias("record_id"), "slug", value.alias("value"))

    pal = rows(table(spark, d, "postings_palantir"), "postings_palantir", F.col("id"), F.col("createdAt"))
    job = table(spark, d, "board_notion").select("slug", F.explode(js.items(js.member(js.parse(F.col("payload")), "jobs"))).alias("j"))
    notion = rows(job, "board_notion", js.text(F.col("j"), "id"), js.text(F.col("j"), "publishedAt"))
    inter = rows(table(spark, d, "board_intercom").select("slug", F.explode("jobs").alias("j")), "board_intercom", F.col("j.id"), F.col("j.updated_at"))
    search = rows(table(spark, d, "search_page1").select("slug", F.explode("results").alias("r")), "search_page1", F.col("r.id"), F.col("r.created"))
    return reduce(DataFrame.unionByName, [pal, notion, inter, search])


def record_instants(spark, d: str) -> DataFrame:
    """source_table, record_id, epoch_us of every dated record, distinct; ids that are blank are left out.

    The zones are one row per board; the join is left to the optimiser, which broadcasts them below its size
    limit and else shuffles, splitting hot boards."""
    zones = table(spark, d, "board_zones").filter("slug is not null").groupBy("slug").agg(F.max_by("zone", "zone").alias("zone"), F.max_by("day_first", "zone").alias("day_first"))
    rows = dated_records(spark, d).filter(strip_blanks(F.col("record_id")) != "")
    placed = with_instant(rows.join(zones, "slug", "left"), "value", "zone", "day_first")
    return placed.filter("epoch_us is not null").select("source_table", "record_id", "epoch_us").distinct()
