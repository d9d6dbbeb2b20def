"""``python -m vacantia.cli fetch|normalise|publish|validate|gate``: the stages over one data folder.

Prints where the result is; ends with 2 if a preset, run, publication or gate fails."""

from __future__ import annotations

import argparse
import logging
import sys
from pathlib import Path

from vacantia import __version__, pipeline, publish
from vacantia.runtime import get_spark
from vacantia.sources import labels, rates
from vacantia.sources.http import FetchError


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="vacantia")
    p.add_argument("--version", action="version", version=__version__)
    sub = p.add_subparsers(dest="stage", required=True)
    for stage in ("fetch", "normalise", "publish", "validate", "gate"):
        s = sub.add_parser(stage)
        s.add_argument("preset", type=Path)
        s.add_argument("--data", type=Path, default=Path("data"))
        if stage == "normalise":
            s.add_argument("--rates", type=Path, help="CSV of a header and a row of units per euro; else the day's are fetched")
            s.add_argument("--labels", type=Path, required=True, help="Parquet of isco_code, label, label_kind")
        if stage == "gate":
            s.add_argument("--manifest", type=Path, required=True)
    return p


def run(args: argparse.Namespace) -> str:
    if args.stage == "validate":
        found = pipeline.preset_issues(pipeline.load_preset(args.preset))
        if found:
            raise pipeline.PresetError("\n".join(found))
        return "ok"
    preset = pipeline.load_preset(args.preset)
    spark = get_spark()
    if args.stage == "gate":
        return "\n".join(publish.gate(spark, publish.read_manifest(args.manifest), preset)) or "ok"

    def daily():
        return rates.daily(spark, args.data / "fx" / "rates.csv")

    if args.stage == "fetch":
        out = pipeline.fetch(spark, preset, args.data)
        pipeline.fetch_benchmarks(spark, preset, args.data, daily)
        return str(out)
    if args.stage == "normalise":
        table = spark.createDataFrame(sorted(rates.parsed(args.rates.read_text(encoding="utf-8")).items()), "currency string, rate double") if args.rates else daily()
        return str(pipeline.run_normalise(spark, preset, args.data, table, labels.load(spark, str(args.labels))))
    return str(pipeline.run_publish(spark, preset, args.data))


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    for handler in logging.getLogger().handlers:
        handler.addFilter(pipeline.RedactingFilter())
    try:
        print(run(args))
    except (pipeline.PresetError, pipeline.EmptyRunError, pipeline.NoRunError, publish.PublishError, publish.GateError, labels.LabelError, FetchError) as e:
        print(e, file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
