"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.expressions import money_sum


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[str] = ("ingestion_timestamp",)
) -> DataFrame:
    """One row per key: the greatest by ``newest_first``, NULL counting as oldest.

    Rows equal in those columns are separated by all remaining columns, so the choice does
    not depend on row order. Spark cuts each task's input to one row per key before the
    exchange (WindowGroupLimit), so a hot key costs no more than any other.
    """
    rest = [name for name in df.columns if name not in keys and name not in newest_first]
    order: list[Column] = [F.desc_nulls_last(name) for name in newest_first]
    order += [F.asc_nulls_last(name) for name in rest]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values of one column."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def aggregate_order_items(items: DataFrame) -> DataFrame:
    """Fold repeated lines of one product in one order: add quantities and totals, keep the price."""
    return items.groupBy("order_id", "product_id").agg(
        F.min("unit_price_usd").alias("unit_price_usd"),
        F.sum("quantity").alias("quantity"),
        money_sum(F.col("line_total_usd")).alias("line_total_usd"),
    )
