"""Command line: ``python -m cityloom format|kpi|dashboard|train`` (or through spark-submit)."""

from __future__ import annotations

import argparse
import logging
from dataclasses import fields

from pyspark.sql import SparkSession

from cityloom.plans import dashboard, formatting, indicators, training
from cityloom.session import build_session, clear_scratch, scratch_dir
from cityloom.sources.zones import Zone, describe


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cityloom", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("format", help="landing files to formatted zone")
    for field in fields(formatting.Landing):
        optional = field.name.endswith("_schema")
        job.add_argument(f"--{field.name.replace('_', '-')}", required=not optional, metavar="DDL" if optional else "PATH")
    job.add_argument("--formatted", required=True, metavar="PATH")
    job.add_argument("--on-mismatch", choices=("cast", "null"), default="cast")
    job.add_argument("--on-missing", choices=("keep", "drop"), default="keep")
    job.add_argument("--strict-names", action="store_true")
    job.add_argument("--listings-by", metavar="COLUMN")
    job.add_argument("--fields-replace", action="store_true")
    job.add_argument("--near-names", type=int, default=0, metavar="N", help="match air-quality areas up to N letters apart, where one name only is that near")
    job.add_argument("--incremental", action="store_true", help="load only the listing files that the table does not have yet")

    for name, text in (("kpi", "formatted zone to indicators"), ("train", "formatted zone to price model")):
        job = jobs.add_parser(name, help=text)
        job.add_argument("--formatted", required=True, metavar="PATH")
        job.add_argument("--exploitation", required=True, metavar="PATH")
        job.add_argument("--mode", choices=("overwrite", "append"), default="overwrite")
    jobs.choices["kpi"].add_argument("--nulls", choices=("skip", "zero"), default="skip")
    jobs.choices["kpi"].add_argument("--incremental", action="store_true", help="read only the listings written since the last run with this option")
    jobs.choices["train"].add_argument("--split-key", metavar="COLUMN")
    jobs.choices["train"].add_argument("--no-frame", action="store_true", help="fit from each data set alone, without forming or writing the joined rows")
    jobs.choices["train"].add_argument("--folds", type=int, default=0, metavar="N", help="with --no-frame: errors of N folds, too")
    job = jobs.add_parser("dashboard", help="indicators to the dashboard's tables")
    job.add_argument("--exploitation", required=True, metavar="PATH")
    job.add_argument("--exclude-seller", action="append", default=[], metavar="AREA")
    for job in jobs.choices.values():
        job.add_argument("--describe", action="store_true", help="log schema, shape and first rows of the tables written")
    return top


# Tables each job writes.
TABLES = {
    "format": ("income", "air_quality", "listings"),
    "kpi": (indicators.KPI_TABLE, indicators.TOP_SELLERS_TABLE, indicators.TOP_AIR_TABLE),
    "dashboard": tuple(dashboard.PREFIX + name for name in (indicators.KPI_TABLE, indicators.TOP_SELLERS_TABLE, indicators.TOP_AIR_TABLE)),
    "train": ("model_frame", "price_model_metrics"),
}
UNFRAMED_TABLES = ("price_model_coefficients", "price_model_metrics")


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = build_session(f"cityloom-{args.job}")
    # All jobs but the dashboard's may keep intermediate tables: without a folder for them a cluster job ends here, before any work.
    stages = args.job != "dashboard"
    if stages:
        scratch_dir(spark, "start")
    try:
        _run(spark, args)
        if args.describe:
            logging.basicConfig(level=logging.INFO)
            written = UNFRAMED_TABLES if args.job == "train" and args.no_frame else TABLES[args.job]
            describe(Zone(spark, args.formatted if args.job == "format" else args.exploitation), *written)
    finally:
        if stages:
            clear_scratch(spark)


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "dashboard":
        dashboard.run(Zone(spark, args.exploitation), args.exclude_seller)
        return
    formatted = Zone(spark, args.formatted)
    if args.job == "format":
        landing = formatting.Landing(**{f.name: getattr(args, f.name) for f in fields(formatting.Landing)})
        choices = formatting.Choices(args.on_mismatch, args.on_missing, args.strict_names, args.listings_by, args.fields_replace, args.near_names)
        formatting.run(spark, landing, formatted, choices, args.incremental)
    elif args.job == "kpi":
        indicators.run(formatted, Zone(spark, args.exploitation), args.mode, args.nulls, args.incremental)
    elif args.no_frame:
        training.run_without_frame(formatted, Zone(spark, args.exploitation), args.mode, split_key=args.split_key, folds=args.folds)
    else:
        training.run(formatted, Zone(spark, args.exploitation), args.mode, split_key=args.split_key)


if __name__ == "__main__":
    main()
