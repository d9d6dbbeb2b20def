"""A run from files to publication, its gate and its command line."""

import io
import json
import logging
import zipfile
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from vacantia import cli, pipeline, publish, schemas
from vacantia.operators import normalise
from vacantia.sources import http, labels, live, rates
from vacantia.sources.registry import ConfigError

NOW = datetime(2025, 6, 1, tzinfo=timezone.utc)
LABELS = [("2511", "data analyst", "alt"), ("2221", "Nurse", "preferred")]


def preset(tmp_path, **more):
    jobs = [{"id": i, "title": t, "absolute_url": f"https://x/j{n}", "location": {"name": p}, "updated_at": d} for i, (n, t, p, d) in enumerate([("1?utm_a=1", "Data Analyst", "Dublin", "2025-05-02T00:00:00Z"), ("1", "Data Analyst", "Dublin", "2025-05-03T00:00:00Z"), ("2", "Head Nurse", "London", "2025-04-30T00:00:00Z"), ("3", "Cook", "London", "2023-01-01T00:00:00Z")])]
    (tmp_path / "feed").mkdir(exist_ok=True)
    (tmp_path / "feed/acme.json").write_text(json.dumps({"jobs": jobs}))
    sources = {"greenhouse": {"enabled": True, "path": str(tmp_path / "feed"), "countries": ["ie", "gb"], "now": "2025-06-01"}, "lever": {"enabled": True, "path": str(tmp_path / "nothing"), "countries": ["ie"]}, "who": {"enabled": True}, "ashby": {"enabled": False}}
    values = {"preset_id": "test", "sources": sources, "gate": {"min_total_rows": 2, "allow_zero_sources": ["lever", "who"]}} | more
    path = tmp_path / "preset.json"
    path.write_text(json.dumps(values))
    return path, values


def test_run(spark, tmp_path):
    path, values = preset(tmp_path)
    data = tmp_path / "data"
    raw = pipeline.fetch(spark, values, data)
    assert spark.read.parquet(str(raw / "postings_raw.parquet")).count() == 4
    fx = spark.createDataFrame([("EUR", 1.0), ("GBP", 0.8)], "currency string, rate double")
    labels = spark.createDataFrame(LABELS, "isco_code string, label string, label_kind string")
    bench = spark.createDataFrame([("2511", "IE", "2024", "EUR", 50000.0, None, None, None, "cso", "https://b", NOW.replace(tzinfo=None))], schemas.BENCHMARK)
    assert pipeline.write_benchmark(bench, data, "cso", "r1") and pipeline.write_benchmark(bench.withColumn("country", F.lit("IRL")), data, "eurostat", "r1") is None
    out = pipeline.run_normalise(spark, values, data, fx, labels, NOW)
    rows = sorted(spark.read.parquet(str(out / "postings.parquet")).collect(), key=lambda r: r["title"])
    assert [(r["title"], r["isco_code"], r["isco_match_method"], r["isco_match_score"]) for r in rows] == [("Data Analyst", "2511", "fuzzy", 1.0), ("Head Nurse", "2221", "fuzzy", 1.0)]
    done = pipeline.run_publish(spark, values, data, NOW)
    assert sorted(str(p.relative_to(done / "postings")) for p in (done / "postings").glob("*/*")) == ["country=GB/year_month=2025-04", "country=IE/year_month=2025-05"]
    back = spark.read.parquet(str(done / "postings"))
    assert {(r["country"], r["year_month"]) for r in back.collect()} == {("IE", "2025-05"), ("GB", "2025-04")} and back.schema["year_month"].dataType.simpleString() == "string"
    values_out = publish.read_manifest(done / "manifest.json")
    assert values_out["postings"] == {"row_count": 2, "source_counts": {"greenhouse": 2}, "country_counts": {"GB": 1, "IE": 1}, "isco_match_method_counts": {"fuzzy": 2}}
    assert values_out["benchmarks"]["source_counts"] == {"cso": 1}
    assert publish.gate(spark, values_out, values) == []
    assert cli.main(["gate", str(path), "--manifest", str(done / "manifest.json")]) == 0
    with pytest.raises(publish.GateError, match="lever"):
        publish.gate(spark, values_out, values | {"gate": {"min_total_rows": 50}})
    assert len(publish.gate(spark, values_out, values | {"gate": {"fail_on_issues": False}})) == 3
    assert cli.main(["validate", str(path)]) == 2
    path.write_text(json.dumps(values | {"sources": {k: v for k, v in values["sources"].items() if k != "who"}}))
    assert cli.main(["validate", str(path)]) == 0


def test_flat_export_and_refusals(spark, tmp_path):
    rows = spark.createDataFrame([("a", "IE", NOW.replace(tzinfo=None))], "posting_id string, country string, posted_at timestamp")
    publish.export(rows, tmp_path, [])
    assert [p.name for p in (tmp_path / "postings").iterdir()] == ["postings.parquet"]
    assert spark.read.parquet(str(tmp_path / "postings/postings.parquet")).first()["year_month"] == "2025-06"
    with pytest.raises(publish.PublishError):
        publish.export(rows, tmp_path, ["nope"])
    with pytest.raises(publish.PublishError):
        publish.export(rows.limit(0), tmp_path, [])


def test_failures(spark, tmp_path):
    _, values = preset(tmp_path)
    with pytest.raises(pipeline.EmptyRunError):
        pipeline.fetch(spark, values | {"sources": {"lever": values["sources"]["lever"]}}, tmp_path / "d")
    with pytest.raises(pipeline.NoRunError):
        pipeline.run_publish(spark, values, tmp_path / "d")
    assert len(pipeline.preset_issues({"sources": {"a": 1, "lever": {"enabled": True}}, "publish": {"partition_by": ["x"]}, "gate": {"min_total_rows": -1}})) == 5
    told = pipeline.preset_issues({"preset_id": "p", "sources": {"nope": {"enabled": True}, "off": {}, "adzuna": {"enabled": True, "max_pages": 21}}, "benchmarks": {"cso": {"enabled": True, "countries": "ie"}, "x": {"enabled": True}, "oecd": {"enabled": True}}})
    assert [t.split()[:2] for t in told] == [["source", "nope"], ["adzuna:", "max_pages"], ["cso:", "countries"], ["benchmark", "x"]]
    assert pipeline.preset_issues({"preset_id": "p", "sources": {}, "benchmarks": [], "publish": 5}) == ["benchmarks is no mapping", "publish is no mapping"]
    (tmp_path / "bad.json").write_text("[]")
    assert cli.main(["validate", str(tmp_path / "bad.json")]) == 2
    with pytest.raises(publish.GateError):
        publish.read_manifest(tmp_path / "bad.json")
    assert [r[0] for r in publish.issues(spark, {}, {}).collect()] == ["no postings block"]
    counts = {"postings": {"row_count": 30, "source_counts": {"lever": 30, "ashby": 0}}, "benchmarks": {"source_counts": {"cso": 1}}}
    wanted = {"sources": {k: {"enabled": True} for k in ("lever", "ashby", "personio")} | {"adzuna": {"enabled": False}, "odd": 3}, "benchmarks": {k: {"enabled": True} for k in ("cso", "oecd")}}
    assert {tuple(r) for r in publish.silent(spark, counts, wanted).collect()} == {("source", "ashby"), ("source", "personio"), ("benchmark", "oecd")}
    assert {tuple(r) for r in publish.silent(spark, counts | {"benchmarks": None}, wanted | {"gate": {"allow_zero_sources": ["ashby"]}}).collect()} == {("source", "personio")}
    for bad in ({"gate": []}, {"gate": {"min_total_rows": -1}}, {"gate": {"allow_zero_sources": "x"}}):
        with pytest.raises(publish.GateError):
            publish.gate(spark, counts, bad | {"gate": bad["gate"] or [1]})


def test_companies_and_settings(tmp_path, monkeypatch):
    (tmp_path / "c.json").write_text(json.dumps({"lever": [" a ", "", "b"]}))
    assert live.companies(tmp_path / "c.json", "lever") == ["a", "b"] and live.companies(tmp_path / "c.json", "ashby") == []
    monkeypatch.setenv("VACANTIA_DATA", "x")
    assert live.settings()["data"] == "x"
    (tmp_path / "c.json").write_text(json.dumps({"lever": "a"}))
    for path in (tmp_path / "c.json", tmp_path / "none.json"):
        with pytest.raises(ConfigError):
            live.companies(path, "lever")


def test_label_snapshots(spark, tmp_path):
    root = "https://c.example/isco/C"
    edges = spark.createDataFrame([(root, root + "62"), (root + "62", root + "6221"), (root + "62", root + "6222"), ("other", root + "9999")], "parent string, child string")
    concepts = spark.createDataFrame([(root + "62", "Growers"), (root + "6221", "Kelp growers"), (root + "6222", " "), (root + "9999", "Not below")], "uri string, title string")
    more = spark.createDataFrame([(root + "6221", "kelp harvester"), (root + "6221", "KELP GROWERS")], "parent string, title string")
    found = labels.from_concepts(concepts, edges, more, root)
    labels.write(found, str(tmp_path / "s"))
    assert [tuple(r) for r in labels.load(spark, str(tmp_path / "s")).collect()] == [("6221", "KELP GROWERS", "alt"), ("6221", "kelp harvester", "alt")]
    for bad in (found.limit(0), found.withColumn("isco_code", F.lit("62")), found.drop("label_kind")):
        bad.write.mode("overwrite").parquet(str(tmp_path / "bad"))
        with pytest.raises(labels.LabelError):
            labels.load(spark, str(tmp_path / "bad"))


def test_throttle():
    assert pipeline.due(None, 24, NOW) and pipeline.due(NOW, 0, NOW) and pipeline.due(NOW - timedelta(hours=24), 24, NOW)
    assert not pipeline.due(NOW - timedelta(hours=23, minutes=59), 24, NOW)


def test_rates(spark, tmp_path):
    text = "Date, USD, GBP, XXX, JPY,\n1 June 2025, 1.10, 0.85, N/A, ,\n"
    box = io.BytesIO()
    with zipfile.ZipFile(box, "w") as z:
        z.writestr("rates.csv", text)
    calls = []

    def download():
        calls.append(1)
        return box.getvalue()

    for _ in range(2):
        got = {r["currency"]: r["rate"] for r in rates.load(spark, tmp_path / "fx/r.csv", download).collect()}
    assert got == {"EUR": 1.0, "USD": 1.1, "GBP": 0.85} and len(calls) == 1
    rates.load(spark, tmp_path / "fx/r.csv", download, now=(tmp_path / "fx/r.csv").stat().st_mtime + rates.TTL_SECONDS)
    assert len(calls) == 2


def test_normalise_pieces(spark):
    rows = spark.createDataFrame([("a", "GB", 50000.0, 60000.0), ("b", "BR", 1.0, 2.0), ("c", "zz", 1.0, None), ("d", "ie", 10.0, None)], "posting_id string, country string, salary_min_eur double, salary_max_eur double").withColumn("salary_annual_eur_p50", F.lit(5.0))
    fx = spark.createDataFrame([("GBP", 0.85), ("GBP", 0.85)], "currency string, rate double")
    got = {r["posting_id"]: (r["salary_min_eur"], r["salary_annual_eur_p50"]) for r in normalise.with_midpoint(normalise.to_euros(rows, fx)).collect()}
    assert got == {"a": (58823.529411764706, (58823.529411764706 + 60000 / 0.85) / 2), "b": (None, None), "c": (None, None), "d": (10.0, None)}
    assert tuple(normalise.unresolved(rows, fx).first()) == ("?,BRL", 2)
    ages = spark.createDataFrame([(NOW.replace(tzinfo=None) - timedelta(days=d),) for d in (10, 170, 180, 200)] + [(None,)], "posted_at timestamp")
    assert normalise.recent(ages, F.lit("2025-06-01").cast("timestamp"), 180).count() == 3
    ties = spark.createDataFrame([("k", 1, "b"), ("k", 1, "a"), (None, 2, "c"), (None, 3, "d")], "k string, o int, v string")
    assert {r["v"] for r in normalise.keep_first(ties, F.col("k"), F.col("o"), F.col("v")).collect()} == {"a", "c"}
    assert {r["v"] for r in normalise.keep_first_ranked(ties, F.col("k"), F.col("o"), F.col("v")).collect()} == {"a", "c"}
    assert normalise.keep_first(ties.limit(0), F.col("k"), F.col("o")).count() == 0


def test_http(spark, tmp_path):
    for n, body in enumerate([{"results": [1, 2]}, {"results": [3]}, {"results": [4, 5]}], 1):
        (tmp_path / f"p{n}.json").write_text(json.dumps(body))
    http.register_http(spark)
    ends = [{"url": f"file://{tmp_path}/p{{page}}.json", "pages": 9, "per_page": 2, "items": "results"}, {"url": f"file://{tmp_path}/none.json"}]
    got = spark.read.format("vacantia_http").option("endpoints", json.dumps(ends)).load().collect()
    assert [(r["page"], json.loads(r["body"])["results"]) for r in sorted(got, key=lambda r: r["page"])] == [(1, [1, 2]), (2, [3])]
    assert spark.read.format("vacantia_http").option("endpoints", "[]").load().count() == 0
    tries = []

    def failing(url, timeout):
        tries.append(url)
        raise OSError(f"cannot reach {url}")

    with pytest.raises(http.FetchError) as e:
        http.fetch("https://x/?app_key=secret&q=1", pause=0, opener=failing)
    assert len(tries) == 3 and "secret" not in str(e.value)
    record = logging.LogRecord("n", 20, "f", 1, "GET %s", ("u?api_key=abc",), None)
    assert pipeline.RedactingFilter().filter(record) and record.getMessage() == "GET u?api_key=REDACTED"
