"""Feeds in JSON and XML, by small files written here, and the adapters over them."""

import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from vacantia import schemas
from vacantia.sources import boards
from vacantia.sources.registry import ConfigError

NOW = "2025-06-01 00:00:00"


def write(folder, name, value):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(value if isinstance(value, str) else json.dumps(value), encoding="utf-8")
    return str(folder)


def rows(spark, name, **config):
    out = boards.ADAPTERS[name](spark, {"now": NOW, "countries": ["ie", "remote-europe"], **config})
    assert out.columns == schemas.POSTING.names
    schemas.violations(out, schemas.POSTINGS).collect()
    return sorted(out.collect(), key=lambda r: r["title"] or "")


def test_search(spark, tmp_path):
    results = [
        {"id": "1", "title": " Tide Analyst ", "company": {"display_name": "A"}, "location": {"display_name": "Dublin"}, "salary_min": 31500, "salary_max": 44500, "salary_is_predicted": "0", "created": "2025-05-01T10:00:00Z", "redirect_url": "https://x/1"},
        {"id": "2", "title": "Nurse", "salary_min": 29000, "salary_max": 37000, "salary_is_predicted": "1", "created": "2025-05-02T10:00:00Z", "redirect_url": "https://x/2"},
        {"id": "3", "title": "Cook", "created": "2025-05-02T10:00:00Z", "redirect_url": "https://x/3"}, {"id": " ", "title": "No id", "redirect_url": "https://x/4"},
    ]
    path = write(tmp_path / "s", "search-ie.json", {"results": results, "count": 4})
    write(tmp_path / "s", "search-gb.json", {"results": []})
    got = rows(spark, "adzuna", path=path)
    assert [(r["title"], r["salary_imputed"], r["salary_annual_eur_p50"], r["country"], r["salary_period"]) for r in got] == [("Cook", None, None, "IE", "annual"), ("Nurse", True, 33000.0, "IE", "annual"), ("Tide Analyst", False, 38000.0, "IE", "annual")]
    assert len(rows(spark, "adzuna", path=path, max_results=2)) == 2


def test_board_with_offices(spark, tmp_path):
    def job(i, title, place, url="https://x/j", offices=()):
        return {"id": i, "title": title, "absolute_url": url, "location": {"name": place}, "updated_at": "2025-05-01T10:00:00-05:00", "offices": list(offices), "departments": []}

    path = write(tmp_path / "b", "acme.json", {"jobs": [
        job(1, "Tide Analyst", "Dublin"), job(2, "Tram Analyst", "Remote (Europe)"), job(3, "Analyst", "Reykjavik"), job(4, "Kelp Harvester", "Dublin"), job(None, "Analyst", "Dublin"), job(6, "Analyst", "Dublin", "mailto:kelp@x"),
        job(7, "Analyst, Ferries", "  ", offices=[{"id": 1, "name": "HQ", "location": "Ireland"}]), job(1, "Tide Analyst", "Dublin"),
    ]})
    got = rows(spark, "greenhouse", path=path, keywords=["analyst"])
    assert [(r["title"], r["country"], r["remote"], r["location_raw"]) for r in got] == [("Analyst, Ferries", "IE", False, "Ireland"), ("Tide Analyst", "IE", False, "Dublin"), ("Tram Analyst", "IE", True, "Remote (Europe)")]
    assert str(got[1]["posted_at"]) == "2025-05-01 15:00:00" and got[1]["company"] == "acme"
    assert len(rows(spark, "greenhouse", path=path)) == 4


def test_bare_list(spark, tmp_path):
    def job(i, text, place, created, url="https://x/l"):
        return {"id": i, "text": text, "categories": {"location": place}, "createdAt": created, "hostedUrl": url, "applyUrl": "https://x/apply"}

    path = write(tmp_path / "l", "acme.json", [job("a", "Analyst", "Dublin", 1718445600000), job("b", "Analyst", "Osaka", 1), job("c", "Fog Signal Keeper", "Remote - Europe", "2024-12-01T10:00:00Z", ""), job("", "Analyst", "Dublin", 1), job("d", "Analyst", "Dublin", 1, "nope")])
    got = rows(spark, "lever", path=path)
    assert [(r["title"], r["remote"], str(r["posted_at"]), r["posting_url"]) for r in got] == [("Analyst", False, "2024-06-15 10:00:00", "https://x/l"), ("Fog Signal Keeper", True, "2024-12-01 10:00:00", "https://x/apply")]


def test_board_with_pay(spark, tmp_path):
    def job(i, place, pay=None, remote=False):
        parts = None if pay is None else {"compensationTiers": [{"components": [{"componentType": "EquityPercentage", "interval": "NONE"}, {"componentType": "Salary", "interval": pay[0], "currencyCode": pay[1], "minValue": pay[2], "maxValue": pay[3]}]}]}
        return {"id": i, "title": f"Job {i}", "location": place, "jobUrl": "https://x/a", "publishedAt": "2025-05-01T00:00:00Z", "isRemote": remote, "compensation": parts}

    path = write(tmp_path / "a", "acme.json", {"jobs": [job("1", "Dublin, Ireland", ("1 YEAR", "EUR", 41000, 52000)), job("2", "Osaka"), job("3", "Remote (Europe)", ("1 HOUR", "EUR", 21, 28), True), job("4", "Dublin", ("1 YEAR", "USD", 61000, 72000))]})
    write(tmp_path / "a", "broken.json", '{"jobs": [')
    got = rows(spark, "ashby", path=path)
    assert [(r["salary_min_eur"], r["salary_max_eur"], r["salary_period"], r["salary_imputed"], r["remote"]) for r in got] == [(41000, 52000, "annual", False, False), (43680, 58240, "annual", False, True), (None, None, None, None, False)]
    assert all(r["salary_min_eur"] is None for r in rows(spark, "ashby", path=path, include_compensation=False))


def test_xml_feed(spark, tmp_path):
    def position(i, name, office, created="2025-05-01 08:00:00"):
        return f"<position><id>{i}</id><office>{office}</office><name>{name}</name><createDate>{created}</createDate></position>"

    path = write(tmp_path / "p", "feed.xml", f"<?xml version='1.0'?><workzag-jobs>{position(1, 'Analyst', 'Dublin')}{position(2, 'Nurse', 'Munich')}{position('', 'Analyst', 'Dublin')}{position(4, ' ', 'Dublin')}{position(5, 'Cook &amp; Chef', 'Dublin', 'soon')}</workzag-jobs>")
    write(tmp_path / "p", "cut.xml", "<workzag-jobs><position><id>9</id>")
    got = rows(spark, "personio", path=path, slug="acme")
    assert [(r["title"], str(r["posted_at"]), r["posting_url"]) for r in got] == [("Analyst", "2025-05-01 08:00:00", "https://acme.jobs.personio.de/job/1"), ("Cook & Chef", NOW, "https://acme.jobs.personio.de/job/5")]
    assert [r["title"] for r in rows(spark, "personio", path=path, slug="acme", countries=["de"])] == ["Nurse"]


def test_registry_and_union(spark):
    with pytest.raises(ValueError):
        boards.register("lever")(lambda s, c: None)
    with pytest.raises(TypeError):
        boards.register("thing")("no function")
    a, b = spark.range(2).withColumn("x", F.lit("a")), spark.range(1).withColumn("y", F.lit("b"))
    assert {tuple(r) for r in boards.united([a, b]).collect()} == {(0, "a", None), (1, "a", None), (0, None, "b")}


class _Feeds(BaseHTTPRequestHandler):
    """Every feed at one address; pages of a search are full, full and short."""

    asked: list[str] = []

    def do_GET(self):
        self.asked.append(self.path)
        path, _, query = self.path.partition("?")
        body, kind = None, "application/json"
        if path.startswith("/search/ie/search/"):
            page = int(path.rsplit("/", 1)[1])
            body = {"results": [{"id": f"{page}{i}", "title": f"Ferry Pilot {page}{i}", "created": "2025-05-02T10:00:00Z", "redirect_url": f"https://x/{page}{i}"} for i in range(2 if page < 3 else 1)]}
        elif path == "/greenhouse/tide":
            body = {"jobs": [{"id": 5, "title": "Diver", "absolute_url": "https://x/5", "location": {"name": "Cork"}, "updated_at": "2025-05-02T10:00:00Z"}]}
        elif path == "/lever/tide":
            body = [{"id": "k", "text": "Diver", "categories": {"location": "Cork"}, "createdAt": 1718445600000, "hostedUrl": "https://x/k"}]
        elif path == "/ashby/tide":
            body = {"jobs": [{"id": "q", "title": "Diver", "location": "Cork", "jobUrl": "https://x/q", "publishedAt": "2025-05-02T10:00:00Z"}]}
        elif path == "/personio/tide":
            body, kind = "<workzag-jobs><position><id>3</id><office>Cork</office><name>Diver</name></position><position><id>4</id><office>Cork</office><name>Cook</name></position></workzag-jobs>", "text/xml"
        self.send_response(200 if body is not None else 404)
        self.send_header("Content-Type", kind)
        self.end_headers()
        if body is not None:
            self.wfile.write((body if isinstance(body, str) else json.dumps(body)).encode())

    def log_message(self, *_):
        pass


@pytest.fixture()
def feeds():
    server = ThreadingHTTPServer(("127.0.0.1", 0), _Feeds)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_live_search_reads_pages_until_a_short_one(spark, feeds, monkeypatch):
    with pytest.raises(ConfigError, match="APP_ID"):
        rows(spark, "adzuna", keywords=["pilot"])
    monkeypatch.setenv("VACANTIA_ADZUNA_APP_ID", "i")
    monkeypatch.setenv("VACANTIA_ADZUNA_APP_KEY", "s")
    _Feeds.asked.clear()
    got = rows(spark, "adzuna", base_url=f"{feeds}/search", countries=["ie", "gb"], keywords=["ferry pilot"], results_per_page=2, max_days_old=7)
    assert len(got) == 5 and {r["country"] for r in got} == {"IE"}
    asked = {p for p in _Feeds.asked if "/ie/" in p}
    assert {p.partition("?")[0] for p in asked} == {f"/search/ie/search/{n}" for n in (1, 2, 3)}
    assert all("app_id=i&app_key=s&what=ferry+pilot&results_per_page=2&content-type=application%2Fjson&max_days_old=7" in p for p in asked)


@pytest.mark.parametrize("kind", ["greenhouse", "lever", "ashby", "personio"])
def test_live_boards(spark, feeds, tmp_path, kind):
    (tmp_path / "companies.json").write_text(json.dumps({kind: ["tide", " gone ", ""]}))
    got = rows(spark, kind, base_url=f"{feeds}/{kind}/{{slug}}", companies_file=str(tmp_path / "companies.json"))
    assert [(r["title"], r["country"], r["company"]) for r in got] == ([("Cook", "IE", "tide")] if kind == "personio" else []) + [("Diver", "IE", "tide")]


def test_configurations():
    assert boards.ADAPTERS.names() == ["adzuna", "ashby", "greenhouse", "lever", "personio"]
    whole = boards.ADAPTERS["adzuna"].config({"enabled": True, "countries": None, "other": 1})
    assert whole["results_per_page"] == 50 and whole["countries"] == [] and whole["max_results"] == 500 and "other" not in whole
    with pytest.raises(ConfigError, match="results_per_page is out of range: 51, max_pages is no int"):
        boards.ADAPTERS["adzuna"].config({"results_per_page": 51, "max_pages": True})
    with pytest.raises(ConfigError, match="timeout_seconds is out of range: 0"):
        boards.ADAPTERS["lever"].config({"timeout_seconds": 0})
