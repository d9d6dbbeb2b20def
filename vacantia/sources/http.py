"""A Python data source that reads paged HTTP (or file) endpoints, one Spark partition per endpoint.

``spark.read.format("vacantia_http").option("endpoints", json).load()`` gives endpoint, tag, page, status, kind (the
content's type) and body. An endpoint is ``{"url": ..., "tag": ..., "pages": n, "per_page": m, "items": "results"}``; its
url may hold ``{page}``, ``tag`` is handed through. Reading stops at an empty or short page; 404 ends an endpoint without rows;
other failures are tried again ``tries`` times with growing pauses and then raise, with credentials blacked out."""

from __future__ import annotations

import json
import re
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from vacantia.functions.text import CREDENTIALS
from vacantia.runtime import ship_package

SCHEMA = "endpoint string, tag string, page int, status int, kind string, body string"


def redact(text: str) -> str:
    """A message with the values of credentials blacked out."""
    return re.sub(CREDENTIALS, r"\1=REDACTED", text)


class FetchError(RuntimeError):
    """An endpoint that failed for good."""


class Answer(NamedTuple):
    status: int
    kind: str
    content: bytes


def fetch(url: str, timeout: float = 30.0, tries: int = 3, pause: float = 1.0, opener=urllib.request.urlopen, accept: str | None = None) -> Answer:
    """The answer to a GET; status 404 and no content if there is nothing."""
    asked = urllib.request.Request(url, headers={"Accept": accept}) if accept else url
    for k in range(tries):
        try:
            with opener(asked, timeout=timeout) as r:
                return Answer(getattr(r, "status", None) or 200, r.headers.get("Content-Type") or "", r.read())
        except urllib.error.HTTPError as e:
            if e.code == 404:
                return Answer(404, "", b"")
            last = e
        except OSError as e:
            if isinstance(getattr(e, "reason", None), FileNotFoundError):
                return Answer(404, "", b"")
            last = e
        if k + 1 < tries:
            time.sleep(pause * 2**k)
    raise FetchError(redact(f"{url}: {last}"))


class Endpoint(InputPartition):
    def __init__(self, value: dict):
        self.value = value


class HttpReader(DataSourceReader):
    def __init__(self, options):
        self.endpoints = json.loads(options.get("endpoints", "[]"))
        self.timeout, self.tries, self.pause = float(options.get("timeout", "30")), int(options.get("tries", "3")), float(options.get("pause", "1"))
        self.accept = options.get("accept")

    def partitions(self):
        return [Endpoint(e) for e in self.endpoints] or [Endpoint({})]

    def read(self, partition) -> Iterator[tuple]:
        e = partition.value
        if not e:
            return
        for page in range(1, int(e.get("pages", 1)) + 1):
            status, kind, content = fetch(e["url"].replace("{page}", str(page)), self.timeout, self.tries, self.pause, accept=self.accept)
            if status == 404:
                return
            body = content.decode("utf-8", "replace")
            yield (redact(e["url"]), e.get("tag"), page, status, kind, body)
            name = e.get("items")
            if name:
                try:
                    n = len(json.loads(body).get(name) or [])
                except (ValueError, AttributeError):
                    return
                if n == 0 or n < int(e.get("per_page", 1)):
                    return


class HttpSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "vacantia_http"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> HttpReader:
        return HttpReader(self.options)


def register_http(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(HttpSource)


def bodies(spark: SparkSession, endpoints: list[dict], **options: object) -> DataFrame:
    """What the endpoints answer, a row per page."""
    register_http(spark)
    reader = spark.read.format("vacantia_http").option("endpoints", json.dumps(endpoints))
    for k, v in options.items():
        if v is not None:
            reader = reader.option(k, str(v))
    return reader.load()
