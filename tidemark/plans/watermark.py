"""The date high-water mark that decides what an incremental gold run reads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.upsert import merge_rows
from tidemark.plans.gold import Frames
from tidemark.sources.tables import TableStore

# Watermark table, its pipeline name and schema.
TABLE = "pipeline_watermark"
PIPELINE_NAME = "gold_star_schema"
SCHEMA = "pipeline_name STRING, last_process_date STRING, updated_at TIMESTAMP"


def latest_process_date(silver: Frames) -> DataFrame:
    """One row: the last process date over all silver frames that track it (one job for all)."""
    tracked = [f.select("silver_process_date") for f in silver.values() if "silver_process_date" in f.columns]
    if not tracked:
        spark = next(iter(silver.values())).sparkSession
        return spark.createDataFrame([(None,)], "latest_process_date STRING")
    dates = reduce(DataFrame.unionByName, tracked)
    return dates.agg(F.max("silver_process_date").alias("latest_process_date"))


def latest_process_dates(silver: Frames) -> DataFrame:
    """The last process date of each silver frame, for watermarks kept per dataset."""
    parts = [
        frame.agg(F.max("silver_process_date").alias("latest_process_date")).select(
            F.lit(name).alias("dataset"), "latest_process_date"
        )
        for name, frame in silver.items()
        if "silver_process_date" in frame.columns
    ]
    return reduce(DataFrame.unionByName, parts)


def read_mark(marks: DataFrame, pipeline_name: str = PIPELINE_NAME) -> DataFrame:
    """One row: the mark of a pipeline, NULL when it has none."""
    return marks.where(F.col("pipeline_name") == pipeline_name).agg(
        F.max("last_process_date").alias("last_process_date")
    )


def with_marks(marks: DataFrame, days: dict[str, str], updated_at: str) -> DataFrame:
    """``marks`` after setting the mark of each pipeline named in ``days``."""
    rows = marks.sparkSession.createDataFrame(
        [(name, day) for name, day in days.items()], "pipeline_name STRING, last_process_date STRING"
    ).withColumn("updated_at", F.lit(updated_at).cast("timestamp"))
    return merge_rows(marks, rows, ["pipeline_name"])


class Watermark:
    """The stored mark. A table that cannot be read is an error; only an absent one is empty."""

    def __init__(self, store: TableStore, name: str = PIPELINE_NAME):
        self.store, self.name = store, name

    def marks(self) -> DataFrame:
        stored = self.store.read_if_exists("gold", TABLE)
        return self.store.spark.createDataFrame([], SCHEMA) if stored is None else stored

    def get(self) -> str | None:
        return read_mark(self.marks(), self.name).first()[0]

    def get_all(self) -> dict[str, str]:
        """All marks by pipeline name; there are a handful of them."""
        marks = self.marks().groupBy("pipeline_name").agg(F.max("last_process_date"))
        return dict(marks.collect())

    def set(self, days: dict[str, str], updated_at: str) -> None:
        """Set several marks in one step."""
        self.store.overwrite("gold", TABLE, with_marks(self.marks(), days, updated_at))
