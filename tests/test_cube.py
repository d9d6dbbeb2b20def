"""Cubes in their forms, by small documents written here."""

import json
import threading
from datetime import datetime, timezone
from functools import partial
from http.server import SimpleHTTPRequestHandler, ThreadingHTTPServer
from itertools import product

import pytest

from vacantia import pipeline
from vacantia.operators import cube, normalise

URL, AT = "https://stats.example/q", "2025-01-01"


def dim(codes, mapped=False):
    return {"category": {"index": {c: i for i, c in enumerate(codes)} if mapped else codes, "label": {c: c for c in codes}}}


def wages():
    ids = {"STATISTIC": ["S1", "S2"], "TLIST(Q1)": ["20253", "20254"], "SECTOR": ["A", "-"], "EMP": ["0", "1", "2", "3"]}
    values = [None] * 32
    values[25 - 16 + 0] = 900.0
    values[8 + 4 + 1] = 1200.0
    values[8 + 4 + 2] = 700.0
    return json.dumps({"id": list(ids), "size": [2, 2, 2, 4], "dimension": {k: dim(v) for k, v in ids.items()}, "value": values})


def test_dense_cube(spark):
    cells = cube.jsonstat_cells(spark.createDataFrame([(1, wages()), (2, "{"), (3, None), (4, "{}")], "n int, t string"), "t")
    assert {(r["n"], r["pos"], r["value"], tuple(r["coords"][k] for k in ("STATISTIC", "TLIST(Q1)", "SECTOR", "EMP"))) for r in cells.collect()} == {
        (1, 9, 900.0, ("S1", "20254", "A", "1")), (1, 13, 1200.0, ("S1", "20254", "-", "1")), (1, 14, 700.0, ("S1", "20254", "-", "2")),
    }
    codes = spark.createDataFrame([("2511",), ("5000",), ("0110",), ("2511",)], "isco_code string")
    got = cube.weekly_wages(cells, codes, "TLIST", ("SECTOR", "-"), "EMP", ("STATISTIC", "S1"), URL, AT).collect()
    assert {(r["isco_code"], r["country"], r["period"], r["median_eur"]) for r in got} == {("2511", "IE", "20254", 62400.0), ("5000", "IE", "20254", 36400.0)}
    assert cube.weekly_wages(cells, codes.limit(0), "TLIST", ("SECTOR", "-"), "EMP", ("STATISTIC", "S1"), URL, AT).count() == 0


def test_sparse_cube_round_trip(spark):
    ids = {"isco08": ["OC2", "OC25", "OC2511"], "geo": ["ie", "de"], "time": ["2018", "2022"]}
    truth = {k: float(i) for i, k in enumerate(product(*ids.values())) if i % 5}
    flat = {str(i): truth[k] for i, k in enumerate(product(*ids.values())) if k in truth}
    doc = json.dumps({"id": list(ids), "size": [3, 2, 2], "dimension": {k: dim(v, True) for k, v in ids.items()}, "value": flat | {"99": 1.0, "x": 2.0}})
    cells = cube.jsonstat_cells(spark.createDataFrame([(doc,)], "t string"), "t")
    assert {tuple(r["coords"][k] for k in ids): r["value"] for r in cells.collect()} == truth
    got = cube.yearly_pay(cells, [], ["IE"], "isco08", "geo", "time", URL, AT).collect()
    assert [(r["isco_code"], r["country"], r["period"], r["median_eur"]) for r in got] == [("2511", "IE", "2022", truth["OC2511", "ie", "2022"])]
    assert cube.yearly_pay(cells, ["9999"], [], "isco08", "geo", "time", URL, AT).count() == 0


def test_observations(spark):
    dims = [{"id": "ISCO08", "values": [{"id": "2511"}, {"id": "25"}]}, {"id": "REF_AREA", "values": [{"id": "ie"}, {"id": "gb"}]}, {"id": "TIME_PERIOD", "values": [{"id": "2024"}]}]
    doc = {"data": {"structures": [{"dimensions": {"observation": dims}, "attributes": {"observation": [{"id": "UNIT_MEASURE", "values": [{"id": "EUR"}, {"id": "GBP"}]}]}}], "dataSets": [{"observations": {"0:0:0": [58000, 0], "0:1:0": [62000, 1], "1:0:0": [1, 0], "0:9:0": [5, None], "1:1:0": [None, 0]}}]}}
    seen = cube.sdmx_observations(spark.createDataFrame([(json.dumps(doc),), ("x",)], "t string"), "t")
    rows = cube.observed_pay(seen, ["2511"], [], URL, AT)
    assert {(r["country"], r["currency"], r["median_eur"]) for r in rows.collect()} == {("IE", "EUR", 58000.0), ("GB", "GBP", 62000.0), (None, "EUR", 5.0)}
    rates = spark.createDataFrame([("GBP", 0.85)], "currency string, rate double")
    euros = normalise.benchmarks_to_euros(rows.filter("country = 'GB'"), rates).first()
    assert abs(euros["median_eur"] - 62000 / 0.85) < 1e-6 and euros["currency"] == "EUR"
    assert normalise.benchmarks_to_euros(rows.filter("country = 'GB'"), rates.limit(0)).count() == 0


def test_latest_goes_by_position(spark):
    doc = json.dumps({"id": ["isco08", "geo", "time"], "size": [1, 1, 3], "dimension": {"isco08": dim(["OC2511"]), "geo": dim(["IE"]), "time": dim(["b", "c", "a"], True)}, "value": [1.0, 2.0, 3.0]})
    cells = cube.jsonstat_cells(spark.createDataFrame([(doc,), (doc.replace("3.0", "null"),)], "t string"), "t")
    got = cube.yearly_pay(cells, [], [], "isco08", "geo", "time", URL, AT).collect()
    assert [(r["period"], r["median_eur"]) for r in got] == [("a", 3.0)]


@pytest.fixture()
def cubes(tmp_path):
    area = {"id": ["isco08", "geo", "time"], "size": [1, 2, 1], "dimension": {"isco08": dim(["OC6221"]), "geo": dim(["IE", "SE"]), "time": dim(["2022"])}, "value": [30_000.0, 40_000.0]}
    (tmp_path / "area.json").write_text(json.dumps(area))
    ids = {"STATISTIC": ["EHQ03C02"], "TLIST(Q1)": ["20251"], "C02665V03225": ["-"], "C02397V02888": ["3"]}
    (tmp_path / "wages.json").write_text(json.dumps({"id": list(ids), "size": [1, 1, 1, 1], "dimension": {k: dim(v) for k, v in ids.items()}, "value": [500.0]}))
    dims = [{"id": "OCC", "values": [{"id": "6221"}]}, {"id": "REF_AREA", "values": [{"id": "GB"}]}, {"id": "TIME_PERIOD", "values": [{"id": "2024"}]}]
    seen = {"dataSets": [{"observations": {"0:0:0": [17_000, 0]}}], "structure": {"dimensions": {"observation": dims}, "attributes": {"observation": [{"id": "UNIT_MEASURE", "values": [{"id": "GBP"}]}]}}}
    (tmp_path / "seen.json").write_text(json.dumps(seen))
    (tmp_path / "page.html").write_text("<html>")
    server = ThreadingHTTPServer(("127.0.0.1", 0), partial(SimpleHTTPRequestHandler, directory=str(tmp_path)))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield {n: f"http://127.0.0.1:{server.server_port}/{n}" for n in ("area.json", "wages.json", "seen.json", "page.html", "none.json")}
    server.shutdown()


def test_benchmarks_are_fetched(spark, tmp_path, cubes, caplog):
    codes = {"enabled": True, "isco_codes": ["6221", "0110"]}
    preset = {"preset_id": "t", "benchmarks": {"cso": codes | {"url": cubes["wages.json"]}, "eurostat": codes | {"url": cubes["area.json"], "countries": ["se"]}, "oecd": codes | {"url": cubes["seen.json"]}, "who": {"enabled": True}}}
    calls = []

    def rates():
        calls.append(1)
        return spark.createDataFrame([("GBP", 0.85)], "currency string, rate double")

    now = datetime.now(timezone.utc)
    done = pipeline.fetch_benchmarks(spark, preset, tmp_path / "d", rates, now)
    assert len(done) == 3 and len(calls) == 1
    rows = pipeline.newest_benchmarks(spark, tmp_path / "d").collect()
    assert {(r["source"], r["isco_code"], r["country"], r["period"], r["currency"], r["median_eur"]) for r in rows} == {("cso", "6221", "IE", "20251", "EUR", 26_000.0), ("eurostat", "6221", "SE", "2022", "EUR", 40_000.0), ("oecd", "6221", "GB", "2024", "EUR", 20_000.0)}
    assert pipeline.fetch_benchmarks(spark, preset, tmp_path / "d", rates, now) == [] and len(calls) == 1
    broken = {"benchmarks": {"cso": {"enabled": True, "url": cubes["none.json"], "min_interval_hours": 0}, "oecd": {"enabled": True, "url": cubes["page.html"], "min_interval_hours": 0}, "eurostat": {"enabled": True, "min_interval_hours": -1}}}
    assert pipeline.fetch_benchmarks(spark, broken, tmp_path / "d", rates, now) == []
    assert {"cso", "oecd", "eurostat"} <= {w for r in caplog.records for w in r.getMessage().split()}
    assert pipeline.fetch_benchmarks(spark, {}, tmp_path / "d", rates, now) == []
