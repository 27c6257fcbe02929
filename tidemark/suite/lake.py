"""Stored layers the registered queries read, written once per session and input folder.

They lie in the folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import gold, runs
from tidemark.plans.bronze import to_bronze
from tidemark.plans.silver import clean
from tidemark.session import shuffles_dropped
from tidemark.sources.catalog import gold_table
from tidemark.sources.files import Files
from tidemark.sources.schemas import DATASETS
from tidemark.sources.tables import TableStore
from tidemark.sources.workspace import fresh_folder
from tidemark.suite.fixtures import FIRST_DATE, FIRST_TS, GIVEN_TABLES, SECOND_DATE, SECOND_TS, raw

# Review texts hold line breaks and quotes; this is how they are written and read as CSV.
REVIEW_CSV = {"multiLine": "true", "escape": '"'}
PLAIN_TEXT_CSV = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_landing(rows: DataFrame, path: str) -> str:
    """Write rows as landing CSV with a header, gzipped, outer blanks kept."""
    rows.write.option("header", True).options(**PLAIN_TEXT_CSV, escape='"', compression="gzip").csv(path)
    return path


def given_bytes(store: TableStore, sf_dir: str) -> int:
    return store.bytes_under(*[f"{sf_dir}/{table}.parquet" for table in GIVEN_TABLES])


def csv_options(dataset: str) -> dict[str, str]:
    return {**PLAIN_TEXT_CSV, **REVIEW_CSV} if dataset == "reviews" else PLAIN_TEXT_CSV


def bronze(spark: SparkSession, sf_dir: str, dataset: str, delivery: int | None = None) -> DataFrame:
    """Bronze rows straight from the derived input, nothing stored."""
    day, stamp = (SECOND_DATE, SECOND_TS) if delivery == 2 else (FIRST_DATE, FIRST_TS)
    return to_bronze(raw(spark, sf_dir, dataset, delivery), dataset, day, stamp)


def silver(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """Silver rows straight from the derived input, nothing stored."""
    return clean(bronze(spark, sf_dir, dataset), dataset, FIRST_DATE, FIRST_TS)


class Stage:
    """Silver and dimension tables of one whole delivery, each stored at its first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.store = TableStore(spark, fresh_folder(spark, "stage"))
        self._scans: dict[str, DataFrame] = {}

    def silver(self, dataset: str) -> DataFrame:
        if dataset not in self._scans:
            rows = silver(self.spark, self.sf_dir, dataset)
            with shuffles_dropped(self.spark):
                self.store.overwrite("silver", dataset, rows, "silver_process_date", few_partitions=True)
            self._scans[dataset] = self.store.read("silver", dataset)
        return self._scans[dataset]

    def _side_by_side(self, make, names) -> dict[str, DataFrame]:
        """Scans by name; tables not stored yet are written side by side."""
        missing = [name for name in names if name not in self._scans]
        if missing:
            with shuffles_dropped(self.spark):
                at_once = runs.abreast(given_bytes(self.store, self.sf_dir))
                outcome = runs.run_all({name: lambda name=name: make(name) for name in missing}, at_once)
            if not outcome.succeeded:
                raise RuntimeError(str(outcome.failed))
        return {name: make(name) for name in names}

    def several(self, *datasets: str) -> dict[str, DataFrame]:
        return self._side_by_side(self.silver, datasets)

    def all_silver(self) -> dict[str, DataFrame]:
        return self.several(*DATASETS)

    def valid(self, dataset: str) -> DataFrame:
        return gold.valid_rows(self.silver(dataset))

    def dimension(self, table: str) -> DataFrame:
        if table not in self._scans:
            rows = self.build_dimension(table)
            with shuffles_dropped(self.spark):
                self.store.overwrite("gold", table, rows)
            self._scans[table] = self.store.read("gold", table)
        return self._scans[table]

    def build_dimension(self, table: str) -> DataFrame:
        if table in gold.KEY_DIMENSIONS:
            feeds = [name for name, _ in gold.KEY_DIMENSIONS[table].feeds]
            return gold.key_dimension(self.several(*feeds), table)
        if table == "dim_date":
            feeds = [name for name, _ in gold.CALENDAR_FEEDS]
            return gold.dim_date(self.spark, self.several(*feeds))
        if table == "dim_customers":
            return gold.dim_customers(self.silver("customers"), FIRST_DATE, FIRST_TS)
        return gold.dim_products(self.silver("products"), self.dimension("dim_category"), FIRST_TS)

    def dims(self) -> dict[str, DataFrame]:
        self.all_silver()  # before the dimensions, which are built side by side and share it
        return {
            **self._side_by_side(self.dimension, runs.GOLD_GROUPS[0]),
            **self._side_by_side(self.dimension, runs.GOLD_GROUPS[1]),
        }

    def fact(self, table: str) -> DataFrame:
        silver = self.all_silver()
        return gold.keyed(gold.fact_rows(table, silver, self.dims()), table)


class TwoDeliveries:
    """All layers run on the first and then, incrementally, on the second delivery."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        folder = fresh_folder(spark, "deliveries")
        with shuffles_dropped(spark):
            self._run(spark, sf_dir, folder)

    def _run(self, spark: SparkSession, sf_dir: str, folder: str) -> None:
        # Events are derived once, the costliest rows of all, and split into the two deliveries.
        derived = f"{folder}/events"
        raw(spark, sf_dir, "events").write.parquet(derived, compression="zstd")
        stored = {"events": spark.read.parquet(derived)}
        self.store, files = TableStore(spark, f"{folder}/tables"), Files(spark)
        for number, day, stamp in ((1, FIRST_DATE, FIRST_TS), (2, SECOND_DATE, SECOND_TS)):
            landing = {name: f"{folder}/landing/{day}/{name}.csv" for name in DATASETS}
            options = {name: csv_options(name) for name in DATASETS}
            make = {
                name: lambda name=name: write_landing(raw(spark, sf_dir, name, number, stored=stored.get(name)), landing[name])
                for name in DATASETS
            }
            self._ended(number, runs.run_all(make, runs.abreast(given_bytes(self.store, sf_dir))))
            # What only one step reads is not kept beside what it made of it.
            if number == 2:
                files.delete(derived)
            self._ended(number, runs.run_bronze(self.store, landing, day, stamp, options))
            files.delete(f"{folder}/landing/{day}")
            self._ended(number, runs.run_silver(self.store, day, stamp))
            self._ended(number, runs.run_gold(self.store, day, stamp, "incremental"))

    @staticmethod
    def _ended(number: int, summary: runs.Summary) -> None:
        if not summary.succeeded:
            raise RuntimeError(f"delivery {number}: {summary.failed}")

    def gold(self, table: str) -> DataFrame:
        return gold_table(self.store, table)


@cache
def _stage(application: str, spark: SparkSession, sf_dir: str) -> Stage:
    return Stage(spark, sf_dir)


@cache
def _two_deliveries(application: str, spark: SparkSession, sf_dir: str) -> TwoDeliveries:
    return TwoDeliveries(spark, sf_dir)


def stage(spark: SparkSession, sf_dir: str) -> Stage:
    return _stage(spark.sparkContext.applicationId, spark, sf_dir)


def two_deliveries(spark: SparkSession, sf_dir: str) -> TwoDeliveries:
    return _two_deliveries(spark.sparkContext.applicationId, spark, sf_dir)
