"""Command line: one dataset, one table or a whole layer per call.

python -m tidemark --base hdfs:///lake bronze 2024-01-15 orders.csv [orders]
python -m tidemark --base hdfs:///lake silver 2024-01-15 [orders]
python -m tidemark --base hdfs:///lake gold 2024-01-15 [fact_order] [--mode full]

Without an item the whole layer runs; for bronze the file argument is then the folder that
holds ``<dataset>.csv`` of all datasets.
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime, timezone
from pathlib import PurePosixPath

from tidemark.plans import runs
from tidemark.plans.bronze import show_report
from tidemark.session import build_session
from tidemark.sources.schemas import DATASETS
from tidemark.sources.tables import TableStore


def parse(arguments: list[str]) -> argparse.Namespace:
    today = datetime.now(timezone.utc)
    parser = argparse.ArgumentParser(prog="tidemark")
    parser.add_argument("--base", required=True, help="folder of the stored tables")
    parser.add_argument("--at", default=today.strftime("%Y-%m-%d %H:%M:%S"), help="time stamp of the run, UTC")
    layers = parser.add_subparsers(dest="layer", required=True)

    bronze = layers.add_parser("bronze")
    bronze.add_argument("date", nargs="?", default=today.strftime("%Y-%m-%d"))
    bronze.add_argument("file", nargs="?", default="events.csv")
    bronze.add_argument("dataset", nargs="?")
    bronze.add_argument("--append", action="store_true", help="add to the date instead of replacing it")
    bronze.add_argument(
        "--csv", action="append", default=[], metavar="OPTION=VALUE", help="option of the CSV reader, e.g. --csv multiLine=true; repeatable"
    )
    bronze.add_argument("--report", action="store_true", help="print sample, schema, dates and validity counts")

    silver = layers.add_parser("silver")
    silver.add_argument("date", nargs="?", default=today.strftime("%Y-%m-%d"))
    silver.add_argument("dataset", nargs="?", choices=sorted(DATASETS))

    gold = layers.add_parser("gold")
    gold.add_argument("date", nargs="?", default=today.strftime("%Y-%m-%d"))
    gold.add_argument("table", nargs="?")
    gold.add_argument("--mode", default="incremental", choices=runs.MODES)
    gold.add_argument("--per-dataset", action="store_true", help="keep one watermark per dataset")
    options = parser.parse_args(arguments)
    if any("=" not in option for option in getattr(options, "csv", [])):
        parser.error("--csv takes OPTION=VALUE")
    return options


def run(options: argparse.Namespace, store: TableStore) -> runs.Summary:
    day, stamp = options.date, options.at
    if options.layer == "bronze":
        path, csv = PurePosixPath(options.file), dict(option.split("=", 1) for option in options.csv)
        if not options.file.endswith(".csv") and options.dataset is None:
            landing = {name: f"{options.file.rstrip('/')}/{name}.csv" for name in DATASETS}
            return runs.run_bronze(store, landing, day, stamp, dict.fromkeys(DATASETS, csv))
        dataset = options.dataset or path.name.removesuffix(".csv")
        mode = "append" if options.append else "replace"
        reports = []
        load = lambda: reports.append(runs.load_bronze(store, dataset, options.file, day, stamp, mode, **csv))
        summary = runs.run_all({dataset: load})
        if options.report and summary.succeeded:
            show_report(store.bronze(dataset), store.delivery_dates(dataset), reports[0])
        return summary
    if options.layer == "silver":
        if options.dataset is None:
            return runs.run_silver(store, day, stamp)
        return runs.run_all({options.dataset: lambda: runs.refine_silver(store, options.dataset, day, stamp)})
    if options.table is None:
        return runs.run_gold(store, day, stamp, options.mode, options.per_dataset)
    runs.check_gold_arguments(options.table, options.mode)
    build = lambda: runs.build_gold(store, options.table, day, stamp, options.mode)
    return runs.run_all({options.table: build})


def main(arguments: list[str]) -> int:
    options = parse(arguments)
    spark = build_session(f"tidemark {options.layer}")
    try:
        summary = run(options, TableStore(spark, options.base))
    finally:
        spark.stop()
    for name, outcome in {**summary.done, **summary.failed}.items():
        print(f"{name}: {outcome}")
    print(f"{len(summary.done)} succeeded, {len(summary.failed)} failed")
    return 0 if summary.succeeded else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
