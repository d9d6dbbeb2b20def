"""The endpoints of the feeds, from their adapters' configurations."""

from __future__ import annotations

import json
import os
from pathlib import Path
from urllib.parse import quote, urlencode

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.sources import http
from vacantia.sources.registry import ConfigError

# Where each feed is asked.
SEARCH = "https://api.adzuna.com/v1/api/jobs"
BOARDS = {
    "greenhouse": "https://boards-api.greenhouse.io/v1/boards/{slug}/jobs?content=true",
    "lever": "https://api.lever.co/v0/postings/{slug}?mode=json",
    "ashby": "https://api.ashbyhq.com/posting-api/job-board/{slug}",
    "personio": "https://{slug}.jobs.personio.de/xml",
}


def settings(prefix: str = "VACANTIA_") -> dict[str, str]:
    """Settings from the environment, without their prefix, in lower case."""
    return {k[len(prefix) :].lower(): v for k, v in os.environ.items() if k.startswith(prefix)}


def read_config(path: Path) -> dict:
    """A JSON file, or YAML where PyYAML is there, as a mapping."""
    try:
        text = path.read_text(encoding="utf-8")
        if path.suffix == ".json":
            values = json.loads(text)
        else:
            try:
                import yaml
            except ImportError as e:
                raise ConfigError(f"{path}: YAML needs PyYAML; JSON works without") from e
            values = yaml.safe_load(text)
    except (OSError, ValueError) as e:
        raise ConfigError(f"{path}: {e}") from e
    if not isinstance(values, dict):
        raise ConfigError(f"{path} is no mapping")
    return values


def companies(path: Path, kind: str) -> list[str]:
    """The boards listed for a kind of feed, stripped, without blanks; none if the kind is missing."""
    listed = read_config(path).get(kind)
    if listed is not None and not isinstance(listed, list):
        raise ConfigError(f"{path}: {kind} is no list")
    return [s for s in (str(x).strip() for x in listed or []) if s]


def search_endpoints(config: dict, secrets: dict[str, str]) -> list[dict]:
    """An endpoint per country and keyword of a job search, read page by page until a short one."""
    if not secrets.get("adzuna_app_id") or not secrets.get("adzuna_app_key"):
        raise ConfigError("adzuna: VACANTIA_ADZUNA_APP_ID and VACANTIA_ADZUNA_APP_KEY are not set")
    fixed = {"app_id": secrets["adzuna_app_id"], "app_key": secrets["adzuna_app_key"]}
    rest = {"results_per_page": config["results_per_page"], "content-type": "application/json"} | ({"max_days_old": config["max_days_old"]} if config["max_days_old"] else {})
    return [
        {
            "url": f"{config['base_url'] or SEARCH}/{quote(country)}/search/{{page}}?" + urlencode(fixed | {"what": word} | rest),
            "tag": f"search-{country.lower()}", "pages": config["max_pages"], "per_page": config["results_per_page"], "items": "results",
        }
        for country in config["countries"] for word in config["keywords"]
    ]


def board_endpoints(kind: str, config: dict) -> list[dict]:
    """An endpoint per board of the companies file."""
    template = config["base_url"] or BOARDS[kind]
    more = "?includeCompensation=true" if config.get("include_compensation") else ""
    return [{"url": template.replace("{slug}", quote(slug)) + more, "tag": slug} for slug in companies(Path(config["companies_file"]), kind)]


def answers(spark: SparkSession, kind: str, config: dict) -> DataFrame:
    """slug, page, body of a feed."""
    if kind != "adzuna" and not config["companies_file"]:
        raise ConfigError(f"{kind}: neither path nor companies_file")
    ends = search_endpoints(config, settings()) if kind == "adzuna" else board_endpoints(kind, config)
    return http.bodies(spark, ends, timeout=config["timeout_seconds"]).select(F.col("tag").alias("slug"), "page", "body")
