"""Runs: presets, folders per run, and the stages fetch, normalise and publish."""

from __future__ import annotations

import logging
import secrets
import shutil
import subprocess
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia import publish, schemas
from vacantia.operators import normalise
from vacantia.runtime import cut_lineage
from vacantia.sources.boards import ADAPTERS, united
from vacantia.sources.http import redact
from vacantia.sources.live import read_config
from vacantia.sources.registry import ConfigError, Registry
from vacantia.sources.statistics import BENCHMARKS

log = logging.getLogger("vacantia")


class PresetError(ValueError):
    """A preset that cannot be run."""


class EmptyRunError(RuntimeError):
    """No source gave any row."""


class NoRunError(RuntimeError):
    """No earlier run to go on from."""


class RedactingFilter(logging.Filter):
    """Blacks out credentials in log records."""

    def filter(self, record: logging.LogRecord) -> bool:
        record.msg, record.args = redact(record.getMessage()), ()
        return True


def load_preset(path: Path) -> dict:
    """A preset with the two things that no run goes without; ``preset_issues`` looks closer."""
    try:
        preset = read_config(path)
    except ConfigError as e:
        raise PresetError(str(e)) from e
    if not isinstance(preset.get("preset_id"), str) or not preset["preset_id"]:
        raise PresetError("preset_id is missing")
    if not isinstance(preset.get("sources"), dict):
        raise PresetError("sources is no mapping")
    return preset


def _block_issues(kind: str, block: dict, registry: Registry) -> list[str]:
    out = []
    for name, config in block.items():
        if not isinstance(config, dict):
            out.append(f"{kind} {name} is no mapping")
        elif config.get("enabled") and name not in registry:
            out.append(f"{kind} {name} is not registered (there are {', '.join(registry.names())})")
        elif config.get("enabled"):
            try:
                whole = registry[name].config(config)
            except ConfigError as e:
                out.append(str(e))
            else:
                if "companies_file" in whole and not whole["companies_file"] and not whole["path"]:
                    out.append(f"{kind} {name} has neither path nor companies_file")
    return out


def preset_issues(preset: dict) -> list[str]:
    """What a preset lacks or says wrongly, all of it."""
    out = [] if isinstance(preset.get("preset_id"), str) and preset.get("preset_id") else ["preset_id is missing"]
    for kind, block, registry, needed in (("source", "sources", ADAPTERS, True), ("benchmark", "benchmarks", BENCHMARKS, False)):
        if isinstance(preset.get(block), dict):
            out += _block_issues(kind, preset[block], registry)
        elif needed or preset.get(block) is not None:
            out.append(f"{block} is no mapping")
    try:
        publish._gate(preset)
    except publish.GateError as e:
        out.append(str(e))
    published = preset.get("publish") or {}
    if not isinstance(published, dict):
        return [*out, "publish is no mapping"]
    by = published.get("partition_by") or []
    if not isinstance(by, list) or set(by) - set(schemas.POSTING.names) - {"year_month"}:
        out.append("publish.partition_by names no columns of the contract")
    return out


def new_run(preset_id: str, now: datetime | None = None) -> str:
    return f"{preset_id}__{(now or datetime.now(timezone.utc)).strftime('%Y%m%dT%H%M%SZ')}-{secrets.token_hex(4)}"


def newest(root: Path, preset_id: str, name: str) -> Path:
    """The newest run folder of a preset that holds ``name``."""
    runs = [p for p in root.glob(f"{preset_id}__*") if (p / name).exists()]
    if not runs:
        raise NoRunError(f"no run of {preset_id} with {name} in {root}")
    return max(runs, key=lambda p: (p.stat().st_mtime, p.name))


def due(last: datetime | None, hours: float, now: datetime) -> bool:
    """Whether something fetched at ``last`` is to be fetched again: not within ``hours``, the boundary being due."""
    return last is None or hours <= 0 or now - last >= timedelta(hours=hours)


def git_sha(where: Path) -> str | None:
    try:
        return subprocess.run(["git", "-C", str(where), "rev-parse", "HEAD"], capture_output=True, text=True, check=True, timeout=10).stdout.strip()
    except (OSError, subprocess.SubprocessError):
        return None


def fetch(spark: SparkSession, preset: dict, data: Path, run: str | None = None) -> Path:
    """All enabled sources as one table of the posting contract below ``data/raw``. A source that fails is logged and left out.

    Sources are written one by one, so that a failure comes up within its own guard, and read again for the union."""
    run = run or new_run(preset["preset_id"])
    out = data / "raw" / run
    done: list[DataFrame] = []
    for name in publish.switched_on(preset, "sources"):
        if name not in ADAPTERS:
            log.warning("unknown source %s", name)
            continue
        part = str(out / "_sources" / name)
        try:
            ADAPTERS[name](spark, preset["sources"][name]).write.mode("overwrite").parquet(part)
        except Exception as e:  # noqa: BLE001 one source's failure is no other's
            log.warning("source %s failed: %s", name, redact(str(e))[:500])
            continue
        done.append(spark.read.parquet(part))
    if not done or all(f.isEmpty() for f in done):
        shutil.rmtree(out, ignore_errors=True)
        raise EmptyRunError("no source gave any row")
    rows = schemas.validate(united(done).select(schemas.POSTING.names), schemas.POSTINGS)
    rows.write.mode("overwrite").parquet(str(out / "postings_raw.parquet"))
    shutil.rmtree(out / "_sources")
    return out


def write_benchmark(rows: DataFrame, data: Path, name: str, run: str) -> Path | None:
    """A benchmark below ``data/raw/benchmarks``; None (and a log line) if it breaks its contract."""
    out = data / "raw" / "benchmarks" / name / f"{run}.parquet"
    try:
        schemas.validate(rows, schemas.BENCHMARKS).write.mode("overwrite").parquet(str(out))
    except schemas.ContractError as e:
        log.warning("benchmark %s left out: %s", name, e)
        return None
    return out


def fetch_benchmarks(spark: SparkSession, preset: dict, data: Path, rates: Callable[[], DataFrame], now: datetime | None = None) -> list[Path]:
    """The enabled benchmarks that are due, each below ``data/raw/benchmarks/<name>``; the paths written.

    A benchmark that is unknown, misconfigured, fails, breaks its contract or has no rows is logged and left out, and
    what was fetched of it before stands. ``rates`` is asked once, when the first one is fetched. None at all is no error."""
    at = now or datetime.now(timezone.utc)
    written: list[Path] = []
    known: DataFrame | None = None
    for name in publish.switched_on(preset, "benchmarks"):
        if name not in BENCHMARKS:
            log.warning("unknown benchmark %s", name)
            continue
        try:
            hours = BENCHMARKS[name].config(preset["benchmarks"][name])["min_interval_hours"]
            before = max((p.stat().st_mtime for p in (data / "raw" / "benchmarks" / name).glob("*.parquet")), default=None)
            if not due(None if before is None else datetime.fromtimestamp(before, timezone.utc), hours, at):
                log.info("benchmark %s is not due yet", name)
                continue
            known = rates() if known is None else known
            # written (or read in whole) once, so that a failure comes up here
            rows = cut_lineage(BENCHMARKS[name](spark, preset["benchmarks"][name], rates=known, retrieved=at.replace(tzinfo=None).isoformat(sep=" ")))
            if rows.isEmpty():
                log.warning("benchmark %s has no rows", name)
                continue
            out = write_benchmark(rows, data, name, new_run(name, at).split("__")[1])
        except Exception as e:  # noqa: BLE001 one benchmark's failure is no other's
            log.warning("benchmark %s failed: %s", name, redact(str(e))[:500])
            continue
        if out is not None:
            written.append(out)
    return written


def newest_benchmarks(spark: SparkSession, data: Path) -> DataFrame | None:
    """The newest file of every benchmark there is, together; None if there is none."""
    frames = []
    for folder in sorted(p for p in (data / "raw" / "benchmarks").glob("*") if p.is_dir()):
        files = sorted(folder.glob("*.parquet"), key=lambda p: (p.stat().st_mtime, p.name))
        if files:
            frames.append(spark.read.parquet(str(files[-1])))
    return united(frames) if frames else None


def run_normalise(spark: SparkSession, preset: dict, data: Path, rates: DataFrame, labels: DataFrame, now: datetime | None = None) -> Path:
    """The newest raw run enriched, below ``data/enriched`` under the same run."""
    raw = newest(data / "raw", preset["preset_id"], "postings_raw.parquet")
    at = F.lit((now or datetime.now(timezone.utc)).replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp")
    rows = normalise.normalise(spark.read.parquet(str(raw / "postings_raw.parquet")), rates, labels, at, (preset.get("filters") or {}).get("since_days", 180))
    out = data / "enriched" / raw.name
    rows.write.mode("overwrite").parquet(str(out / "postings.parquet"))
    bench = newest_benchmarks(spark, data)
    if bench is not None:
        try:
            schemas.validate(normalise.benchmarks_to_euros(bench, rates), schemas.BENCHMARKS).write.mode("overwrite").parquet(str(out / "benchmarks.parquet"))
        except schemas.ContractError as e:
            log.warning("benchmarks left out: %s", e)
    return out


def run_publish(spark: SparkSession, preset: dict, data: Path, now: datetime | None = None) -> Path:
    """The newest enriched run as publication below ``data/publish``, with benchmarks (if any) and manifest."""
    enriched = newest(data / "enriched", preset["preset_id"], "postings.parquet")
    rows = spark.read.parquet(str(enriched / "postings.parquet"))
    by = (preset.get("publish") or {}).get("partition_by", ["country", "year_month"])
    out = data / "publish" / enriched.name
    publish.export(rows, out, by)
    bench = None
    if (enriched / "benchmarks.parquet").exists():
        bench = spark.read.parquet(str(enriched / "benchmarks.parquet"))
        if bench.isEmpty():
            bench = None
        else:
            bench.write.mode("overwrite").parquet(str(out / "benchmarks.parquet"))
    values = publish.manifest(rows, preset["preset_id"], enriched.name, (now or datetime.now(timezone.utc)).isoformat(), by, bench, git_sha(Path(__file__).parent))
    publish.write_manifest(values, out / "manifest.json")
    return out
