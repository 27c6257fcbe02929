"""Reading landing CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.schemas import declared_schema


def read_landing(
    spark: SparkSession,
    path: str,
    dataset: str,
    *,
    strict_header: bool = False,
    with_source_file: bool = False,
    **csv_options: str,
) -> DataFrame:
    """Scan CSV files of ``dataset``.

    Declared datasets bind by position and turn unparsable cells into NULL;
    ``strict_header`` rejects files whose header names differ from the schema. Others
    are inferred. ``with_source_file`` adds the path each row came from.
    """
    reader = spark.read.option("header", True).options(**csv_options)
    schema = declared_schema(dataset)
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema).option("enforceSchema", not strict_header)
    rows = reader.csv(path)
    if with_source_file:
        rows = rows.select("*", rows["_metadata.file_path"].alias("source_file"))
    return rows
