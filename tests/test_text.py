"""Text expressions against Python's own libraries, and their properties."""

import hashlib
from urllib.parse import parse_qsl, urlencode, urlparse, urlunparse

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vacantia.functions import lookup, text


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(build(F.col("v")).alias("r")).first()["r"]


def canonical(url):
    p = urlparse(url.strip())
    keep = [(k, v) for k, v in parse_qsl(p.query, keep_blank_values=True) if not k.lower().startswith("utm_") and k.lower() not in text.TRACKING]
    return urlunparse((p.scheme.lower(), p.netloc.lower(), p.path.rstrip("/"), p.params, urlencode(keep), ""))


URLS = [
    "https://Ex.com/a/?b=1&a=%20x&utm_x=1#f", "HTTPS://EX.com/A?flag", "https://ex.com/?a=1;b=2", "https://ex.com/p;q?x=", "https://ex.com///", "http://a.b/c d?e=f g", "https://x.y/?a=~*&b=%zz", "https://x.y/p?ref=1&q=2&REF_src=3",
    " https://x.y/p/ ", "https://x.y", "https://x.y?a=b=c&&d", "https://x.y/ü?ö=ß", "ftp://h/p?fbclid=1", "x", "https://x.y/a;b/c?d", "https://x.y/p?a=1+2",
]


def test_canonical_url_equals_urllib(spark):
    got = spark.createDataFrame([(u,) for u in URLS], "u string").select("u", text.canonical_url(F.col("u")).alias("c")).collect()
    assert {r["u"]: r["c"] for r in got} == {u: canonical(u) for u in URLS}
    assert one(spark, None, text.canonical_url) == "" and one(spark, "", text.canonical_url) == ""


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abAB/?&=;%+~*#:.2", max_size=30).map(lambda s: "https://h.example/" + s), min_size=60, max_size=60))
def test_canonical_url_is_idempotent_and_equals_urllib(spark, urls):
    df = spark.createDataFrame([(u,) for u in urls], "u string").select("u", text.canonical_url(F.col("u")).alias("a"))
    got = df.select("u", "a", text.canonical_url(F.col("a")).alias("b")).collect()
    wrong = [(r["u"], r["a"], r["b"]) for r in got if r["a"] != canonical(r["u"]) or (";" not in r["u"] and r["a"] != r["b"])]
    assert wrong == []


def test_dedupe_key(spark):
    row = spark.createDataFrame([(None, " Nurse ", None, "IE"), ("https://A.b/c/?utm_x=1", "t", "c", "IE")], "u string, t string, c string, k string")
    got = [r[0] for r in row.select(text.dedupe_key(F.col("u"), F.col("t"), F.col("c"), F.col("k"))).collect()]
    assert got == [hashlib.sha1(x).hexdigest() for x in (b"tcc:nurse||IE", b"url:https://a.b/c")]


def test_clean_title(spark):
    cases = {"Analyst (m/f/d) - Berlin": "analyst berlin", None: "", "  ": "", "C++ / C# Dev Lead": "c c dev lead", "(all)": ""}
    for raw, want in cases.items():
        assert one(spark, raw, text.clean_title) == want


def test_match_country(spark):
    cases = [
        ("Dublin", ["ie"], ("IE", False)), ("Remote (Europe)", ["ie", "remote-europe"], ("IE", True)), ("Dublin, Remote", ["ie", "remote-europe"], ("IE", False)), ("Anywhere", ["remote-worldwide"], (None, True)),
        ("Munich or Paris", ["fr", "de"], ("FR", False)), ("Ukraine", ["gb"], ("GB", False)), (None, ["ie"], (None, False)), ("", ["ie"], (None, False)), ("San Francisco", ["ie", "remote-europe"], (None, False)), ("EMEA", ["de", "remote-europe", "ie"], ("DE", True)), ("Dublin", [], (None, False)),
    ]
    for place, allowed, want in cases:
        country, remote = text.match_country(F.col("v"), allowed)
        r = spark.createDataFrame([(place,)], "v string").select(country.alias("c"), remote.alias("r")).first()
        assert (r["c"], r["r"]) == want, place


def test_moments_flags_and_lookups(spark):
    never = F.lit("2000-01-01").cast("timestamp")
    assert str(one(spark, "1701432000000", lambda c: text.moment(c, never))) == "2023-12-01 12:00:00"
    assert str(one(spark, "2024-12-01T10:00:00Z", lambda c: text.moment(c, never))) == "2024-12-01 10:00:00"
    assert str(one(spark, "soon", lambda c: text.moment(c, never))) == "2000-01-01 00:00:00"
    assert [one(spark, v, text.flag) for v in ("0", "1", "", None, "x")] == [False, True, None, None, None]
    assert [one(spark, v, lookup.wage_bucket) for v in ("1111", "5000", "9999", "0110", None, "x")] == ["1", "2", "3", None, None, None]
    assert [one(spark, v, lookup.major_label) for v in ("1", "x", None)] == ["Managers", "ISCO x", "Unclassified"]
    assert one(spark, "u?APP_ID=1&q=2&api-key=k'", text.redacted) == "u?APP_ID=REDACTED&q=2&api-key=REDACTED'"
    assert spark.createDataFrame([(None,), ("Data Analyst",)], "v string").filter(text.has_keyword(F.col("v"), ["ANALYST"])).count() == 1
