"""Exchange rates from a zipped CSV of one header and one data row, kept for a day."""

from __future__ import annotations

import io
import time
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from vacantia.sources.http import FetchError, fetch

TTL_SECONDS = 24 * 3600
# Fixed value: where the daily rates of the euro are.
URL = "https://www.ecb.europa.eu/stats/eurofxref/eurofxref.zip"


def fresh(path: Path, now: float | None = None, ttl: float = TTL_SECONDS) -> bool:
    """Whether a cached file is younger than ``ttl``."""
    return path.exists() and (now or time.time()) - path.stat().st_mtime < ttl


def unzipped(archive: bytes) -> str:
    """The text of the only CSV in an archive."""
    with zipfile.ZipFile(io.BytesIO(archive)) as z:
        names = [n for n in z.namelist() if n.lower().endswith(".csv")]
        if len(names) != 1:
            raise ValueError(f"expected one CSV, found {len(names)}")
        return z.read(names[0]).decode("utf-8-sig")


def parsed(text: str) -> dict[str, float]:
    """Units per euro by currency; blank, 'N/A' and unreadable cells are left out, EUR is 1."""
    lines = [line for line in text.splitlines() if line.strip()]
    if len(lines) < 2:
        raise ValueError("expected a header and a data row")
    out = {"EUR": 1.0}
    for name, cell in zip(lines[0].split(","), lines[1].split(",")):
        try:
            value = float(cell)
        except ValueError:
            continue
        if len(name.strip()) == 3 and value > 0:
            out[name.strip().upper()] = value
    return out


def load(spark: SparkSession, cache: Path, download, now: float | None = None) -> DataFrame:
    """(currency, rate). ``download()`` gives the archive's bytes and is called only if ``cache`` is no longer fresh."""
    if not fresh(cache, now):
        text = unzipped(download())
        parsed(text)
        cache.parent.mkdir(parents=True, exist_ok=True)
        cache.write_text(text, encoding="utf-8")
    return spark.createDataFrame(sorted(parsed(cache.read_text(encoding="utf-8")).items()), "currency string, rate double")


def daily(spark: SparkSession, cache: Path, url: str = URL) -> DataFrame:
    """(currency, rate) of the day, from ``cache`` while it is fresh, else from ``url``."""

    def download() -> bytes:
        answer = fetch(url)
        if answer.status != 200:
            raise FetchError(f"{url}: nothing there")
        return answer.content

    return load(spark, cache, download)
