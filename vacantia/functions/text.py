"""Column expressions on titles, URLs, places and times. All stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacantia.runtime import strip_blanks

# Names of places by which texts tell a country, looked for anywhere in the text.
COUNTRY_NAMES = {
    "ie": ("ireland", "dublin", "cork", "galway", "limerick", "waterford"),
    "gb": ("united kingdom", "uk", "england", "scotland", "wales", "london", "manchester", "edinburgh", "glasgow", "birmingham", "leeds"),
    "de": ("germany", "deutschland", "berlin", "munich", "münchen", "hamburg", "frankfurt", "cologne", "köln", "stuttgart"),
    "fr": ("france", "paris", "lyon", "marseille", "toulouse"),
    "nl": ("netherlands", "nederland", "amsterdam", "rotterdam", "utrecht", "eindhoven"),
    "es": ("spain", "españa", "madrid", "barcelona", "valencia", "sevilla", "seville"),
    "it": ("italy", "italia", "rome", "roma", "milan", "milano", "turin", "torino"),
    "be": ("belgium", "brussels", "bruxelles", "antwerp", "antwerpen"),
    "at": ("austria", "vienna", "wien"),
    "pt": ("portugal", "lisbon", "lisboa", "porto"),
    "fi": ("finland", "helsinki"),
    "se": ("sweden", "stockholm", "gothenburg"),
    "dk": ("denmark", "copenhagen"),
}
# Texts that tell remote work, by the pseudo-code that allows it.
REMOTE_NAMES = {
    "remote-europe": ("remote (europe)", "remote europe", "remote, europe", "remote - europe", "europe", "emea"),
    "remote-worldwide": ("remote", "worldwide", "anywhere"),
}
# Names of query parameters that only track.
TRACKING = ("fbclid", "gclid", "mc_cid", "mc_eid", "igshid", "yclid", "_hsenc", "_hsmi", "ref", "ref_src", "source")

# Fixed value: credentials in URLs and settings.
CREDENTIALS = r"(?i)\b(app_id|app_key|api_key|api-key)=[^&\s'\"]+"


def clean_title(c: Column) -> Column:
    """Lower case, bracketed parts and all but a-z, 0-9 and blanks made blanks, blanks made one; null gives ''."""
    bare = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\([^)]*\)", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"[^a-z0-9\s]+", " "), r"\s+", " "))


def _decoded(c: Column) -> Column:
    return F.try_url_decode(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encoded(c: Column) -> Column:
    """As form data: blanks as '+', '~' plain and '*' escaped."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical_url(url: Column) -> Column:
    """Lower scheme and host, no fragment, no slashes at the path's end, no tracking parameters; null gives ''.

    The query keeps its order and its empty values and is encoded anew, so that equal queries look equal;
    ``;params`` of the last path segment stay. Escapes that are none are kept as text."""
    u = strip_blanks(F.coalesce(url, F.lit("")))
    rfc = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
    part = [F.regexp_extract(u, f"(?s){rfc}", i) for i in range(1, 5)]
    scheme, host = F.lower(part[0]), F.lower(part[1])
    params = F.regexp_extract(part[2], r"(;[^/]*)$", 1)
    path = F.regexp_replace(F.substring(part[2], F.lit(1), F.length(part[2]) - F.length(params)), "/+$", "")
    params = F.when(F.length(params) > 1, params).otherwise("")
    path = F.when((host != "") & (path == "") & (params != ""), F.lit("/")).otherwise(path)
    pairs = F.transform(F.filter(F.split(part[3], "&"), lambda p: p != ""), lambda p: F.struct(_decoded(F.substring_index(p, "=", 1)).alias("k"), _decoded(F.regexp_extract(p, r"(?s)^[^=]*=(.*)$", 1)).alias("v")))
    kept = F.filter(pairs, lambda p: ~F.lower(p["k"]).startswith("utm_") & ~F.lower(p["k"]).isin(*TRACKING))
    query = F.array_join(F.transform(kept, lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")
    return F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""), F.when(host != "", F.concat(F.lit("//"), host)).otherwise(""), path, params, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def dedupe_key(url: Column, title: Column, company: Column, country: Column) -> Column:
    """SHA-1 of the canonical URL, or without one of title, company and country; nulls count as ''."""
    u = canonical_url(url)
    text = [F.coalesce(x, F.lit("")) for x in (company, country)]
    return F.sha1(F.when(u != "", F.concat(F.lit("url:"), u)).otherwise(F.concat(F.lit("tcc:"), F.lower(strip_blanks(F.coalesce(title, F.lit("")))), F.lit("|"), text[0], F.lit("|"), text[1])))


def posting_id(source: str, *parts: Column) -> Column:
    """SHA-1 of the source and the parts that identify a posting there, joined by colons; nulls count as ''."""
    return F.sha1(F.concat_ws(":", F.lit(source), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def _tells(c: Column, names: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(n)) for n in names])


def match_country(place: Column, allowed: list[str]) -> tuple[Column, Column]:
    """(country, remote) that a place's text tells: the first allowed country named anywhere in it, else, where a
    remote pseudo-code is allowed and told, the first allowed country with remote true (null if none is).

    Names are substrings, so that 'uk' is also found in Ukraine. Null and '' tell nothing: (null, false)."""
    text = F.lower(F.coalesce(place, F.lit("")))
    real = [c for c in allowed if c.lower() in COUNTRY_NAMES]
    named = F.coalesce(*[F.when(_tells(text, COUNTRY_NAMES[c.lower()]), c.upper()) for c in real]) if real else F.lit(None).cast("string")
    far = [_tells(text, REMOTE_NAMES[c.lower()]) for c in allowed if c.lower() in REMOTE_NAMES]
    remote = named.isNull() & reduce(lambda a, b: a | b, far) if far else F.lit(False)
    home = F.lit(real[0].upper()) if real else F.lit(None).cast("string")
    return F.coalesce(named, F.when(remote, home)), remote


def has_keyword(title: Column, keywords: list[str]) -> Column:
    """Whether a title holds any keyword, case aside; without keywords every title does, null ones included."""
    if not keywords:
        return F.lit(True)
    return F.coalesce(_tells(F.lower(title), tuple(k.lower() for k in keywords)), F.lit(False))


def moment(c: Column, otherwise: Column) -> Column:
    """A time given as epoch milliseconds or as ISO text, else ``otherwise``."""
    return F.coalesce(F.timestamp_millis(strip_blanks(c).try_cast("long")), F.try_to_timestamp(strip_blanks(c)), otherwise)


def year_month(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def week(c: Column) -> Column:
    """The Monday of a time's week."""
    return F.to_date(F.date_trunc("week", c))


def flag(c: Column) -> Column:
    """'0', '1' or another whole number as boolean; null, '' and other texts give null."""
    return c.try_cast("int") != 0


def redacted(c: Column) -> Column:
    """Text with the values of credentials in URLs and settings blacked out."""
    return F.regexp_replace(c, CREDENTIALS, "$1=REDACTED")
