"""Official wage statistics as rows of the benchmark contract: three cubes, each an adapter with its options.

An adapter is called with the configuration and, by name, exchange rates. Answers that are missing or no JSON give no rows."""

from __future__ import annotations

from urllib.parse import urlencode

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.operators import cube, normalise
from vacantia.sources import http
from vacantia.sources.registry import STATISTICS, Option, Registry

BENCHMARKS = Registry()

# Where the cubes are, their default contents and the names of their dimensions.
CSO = "https://ws.cso.ie/public/api.restful/PxStat.Data.Cube_API.ReadDataset/{dataset}/JSON-stat/2.0/en"
EUROSTAT = "https://ec.europa.eu/eurostat/api/dissemination/sdmx/2.1/data/{dataset}"
OECD = "https://sdmx.oecd.org/public/rest/data"
CSO_OPTIONS = {"dataset_code": Option(str, "EHQ03"), "statistic": Option(str, "EHQ03C02"), "sector": Option(str, "-"), "min_interval_hours": Option(int, 168, least=0)}
EUROSTAT_OPTIONS = {
    "dataset": Option(str, "earn_ses_annual"), "indic_se": Option(str, "MEAN_E_EUR"), "sex": Option(str, "T"), "worktime": Option(str, "FT"), "age": Option(str, "TOTAL"),
    "nace_r2": Option(str, "B-S_X_O"), "min_interval_hours": Option(int, 720, least=0),
}
OECD_OPTIONS = {"base": Option(str, OECD), "dataflow_id": Option(str, "OECD.ELS.SAE,DSD_EARNINGS@DF_EAR_MEI,1.0"), "key": Option(str, "all"), "min_interval_hours": Option(int, 720, least=0)}
SECTOR, BUCKET, STATISTIC, QUARTER = "C02665V03225", "C02397V02888", "STATISTIC", "TLIST"


def _now(retrieved: str | None) -> Column:
    return F.lit(retrieved).cast("timestamp") if retrieved else F.current_timestamp()


def _documents(spark: SparkSession, url: str, kinds: str | None = None) -> DataFrame:
    """The answer of ``url`` as one row (body), if its type, where given, is of ``kinds``."""
    got = http.bodies(spark, [{"url": url}], timeout=60, accept=kinds or "application/json")
    return got.filter(F.lower("kind").contains("json")).select("body") if kinds else got.select("body")


@BENCHMARKS.register("cso", STATISTICS | CSO_OPTIONS)
def cso(spark: SparkSession, config: dict, rates: DataFrame | None = None, retrieved: str | None = None) -> DataFrame:
    """Weekly earnings by three wide groups of occupations, for Ireland only; in euros already."""
    url = config["url"] or CSO.format(dataset=config["dataset_code"])
    here = not config["countries"] or "IE" in {c.upper() for c in config["countries"]}
    codes = spark.createDataFrame([(c,) for c in (config["isco_codes"] if here else [])], "isco_code string")
    return cube.weekly_wages(cube.jsonstat_cells(_documents(spark, url), "body"), codes, QUARTER, (SECTOR, config["sector"]), BUCKET, (STATISTIC, config["statistic"]), url, _now(retrieved))


@BENCHMARKS.register("eurostat", STATISTICS | EUROSTAT_OPTIONS)
def eurostat(spark: SparkSession, config: dict, rates: DataFrame | None = None, retrieved: str | None = None) -> DataFrame:
    """Yearly earnings by occupation and country."""
    asked = {"format": "JSON", "lang": "EN", "unit": "EUR"} | {k: config[k] for k in ("sex", "worktime", "age", "nace_r2", "indic_se")}
    asked |= {"geo": ",".join(c.upper() for c in config["countries"])} if config["countries"] else {}
    url = config["url"] or EUROSTAT.format(dataset=config["dataset"])
    cells = cube.jsonstat_cells(_documents(spark, url if config["url"] else f"{url}?{urlencode(asked)}"), "body")
    return _euros(cube.yearly_pay(cells, config["isco_codes"], config["countries"], "isco08", "geo", "time", url, _now(retrieved)), rates)


@BENCHMARKS.register("oecd", STATISTICS | OECD_OPTIONS)
def oecd(spark: SparkSession, config: dict, rates: DataFrame | None = None, retrieved: str | None = None) -> DataFrame:
    """Observed pay by occupation and country, in the currencies that the cube names. Answers that are not declared as JSON give no rows."""
    url = config["url"] or f"{config['base']}/{config['dataflow_id']}/{config['key']}?format=jsondata"
    seen = cube.sdmx_observations(_documents(spark, url, "application/vnd.sdmx.data+json, application/json"), "body")
    return _euros(cube.observed_pay(seen, config["isco_codes"], config["countries"], url, _now(retrieved)), rates)


def _euros(rows: DataFrame, rates: DataFrame | None) -> DataFrame:
    known = rates if rates is not None else rows.sparkSession.createDataFrame([("EUR", 1.0)], "currency string, rate double")
    return normalise.benchmarks_to_euros(rows, known)
