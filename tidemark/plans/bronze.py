"""Bronze: landing rows as they are, plus identity, quality flags and lineage."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators.keys import with_record_id

# Quality codes.
FAULTS = ("NULL_RECORD_ID", "EMPTY_RECORD_ID")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case column names, outer blanks cut, inner spaces as underscores; collisions are errors."""
    names = [name.lower().strip().replace(" ", "_") for name in df.columns]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"column names collide after normalisation: {', '.join(repeated)}")
    return df.toDF(*names)


def with_quality_flags(df: DataFrame) -> DataFrame:
    """Flag rows without a usable record id. No row is dropped."""
    flag = F.when(F.col("record_id").isNull(), FAULTS[0]).when(F.col("record_id") == "", FAULTS[1])
    return df.withColumn("dq_error", flag).withColumn("is_valid_record_id", F.col("dq_error").isNull())


def to_bronze(landing: DataFrame, dataset: str, ingest_date: str, ingested_at: str) -> DataFrame:
    """Bronze rows of one delivery. ``source_file`` is kept if the scan supplied it, else NULL."""
    rows = with_quality_flags(with_record_id(normalize_columns(landing), dataset))
    lineage = F.col("source_file") if "source_file" in rows.columns else F.lit(None).cast("string")
    own = [name for name in rows.columns if name != "source_file"]
    return rows.select(
        *own,
        F.lit(ingest_date).alias("ingest_date"),
        F.lit(ingested_at).cast("timestamp").alias("ingestion_timestamp"),
        lineage.alias("source_file"),
    )


def report_partitions(bronze: DataFrame) -> DataFrame:
    return bronze.select("ingest_date").distinct().orderBy("ingest_date")


def report_validity(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("is_valid_record_id").count()


@dataclass(frozen=True)
class LoadReport:
    """What one load wrote: records in all, with and without a usable id, and by fault."""

    records: int
    usable: int
    unusable: int
    faults: dict[str, int]


def observed(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """Bronze rows that count themselves while they are written."""
    seen = Observation()
    faults = [F.count_if(F.col("dq_error") == code).alias(code) for code in FAULTS]
    usable = F.count_if("is_valid_record_id").alias("usable")
    return rows.observe(seen, F.count("*").alias("records"), usable, *faults), seen


def report_of(seen: Observation) -> LoadReport:
    found = seen.get
    faults = {code: found[code] for code in FAULTS if found[code]}
    return LoadReport(found["records"], found["usable"], found["records"] - found["usable"], faults)


def show_report(bronze: DataFrame, dates: Sequence[str], load: LoadReport | None = None) -> None:
    """Print what a load left behind: a sample, the schema, all delivery dates, and what it counted on the way."""
    bronze.show(5, truncate=False)
    bronze.printSchema()
    print("delivery dates:", ", ".join(sorted(dates)))
    if load is not None:
        print(f"{load.records} records, {load.usable} usable, {load.unusable} not:", load.faults)
