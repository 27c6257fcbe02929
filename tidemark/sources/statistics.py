"""Smallest and largest values of stored columns, from the footers of Parquet files.

Spark answers MIN, MAX and COUNT over a Parquet table from the files' footers where its DataSource V2 reader is used and
aggregate push-down is on; no row is read. Both are settings of a session, so a session of its own asks, and those of the caller stay as they are.
Footers hold bounds of numbers, booleans and dates; other columns, and files without a column of the table or without its
statistics, are read as usual.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructType

IN_FOOTERS = (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DateType)
SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_session(spark: SparkSession) -> SparkSession:
    asking = spark.newSession()
    for key, value in SETTINGS.items():
        asking.conf.set(key, value)
    return asking


def bounds_frame(spark: SparkSession, path: str, schema: StructType, columns: Sequence[str]) -> DataFrame:
    """One row: ``min_<column>`` and ``max_<column>`` of each column, answered by footers where Spark can."""
    stored = footer_session(spark).read.schema(schema).parquet(path)
    return stored.agg(*[f(name).alias(f"{f.__name__}_{name}") for name in columns for f in (F.min, F.max)])


def bounds(spark: SparkSession, path: str, schema: StructType, columns: Sequence[str]) -> dict[str, tuple]:
    """(smallest, largest) value of each column; (None, None) for a column without values."""
    out = {}
    cheap = [name for name in columns if isinstance(schema[name].dataType, IN_FOOTERS)]
    if cheap:
        try:
            row = bounds_frame(spark, path, schema, cheap).first()
            out = {name: (row[f"min_{name}"], row[f"max_{name}"]) for name in cheap}
        except (PySparkException, Py4JJavaError):
            # a file without the column or without statistics; what else may be wrong fails again when the columns are read
            out = {}
    rest = [name for name in columns if name not in out]
    if rest:
        stored = spark.read.schema(schema).parquet(path)
        row = stored.agg(*[f(name).alias(f"{f.__name__}_{name}") for name in rest for f in (F.min, F.max)]).first()
        out |= {name: (row[f"min_{name}"], row[f"max_{name}"]) for name in rest}
    return out
