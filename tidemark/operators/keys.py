"""Record ids and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.sources.schemas import DATASETS

# Number of hash slots surrogate keys are dealt from. It bounds the rows one task sorts
# (a slot holds about 1/65536 of the table) and must be far above the shuffle parallelism.
KEY_SLOTS = 65536


def with_record_id(df: DataFrame, dataset: str) -> DataFrame:
    """Add the canonical record id of a dataset and the name of the column(s) it came from.

    A composite id skips NULL parts, as ``concat_ws`` does. A dataset that is unknown or
    lacks its key column gets a NULL id and the source ``NOT_FOUND``.
    """
    known = DATASETS.get(dataset)
    key = known.key if known and set(known.key) <= set(df.columns) else ()
    if not key:
        record_id, origin = F.lit(None).cast("string"), "NOT_FOUND"
    elif len(key) == 1:
        record_id, origin = F.trim(F.col(key[0]).cast("string")), key[0]
    else:
        record_id = F.concat_ws("_", *[F.col(part).cast("string") for part in key])
        origin = "_".join(key)
    return df.withColumns({"record_id": record_id, "record_id_source": F.lit(origin)})


def key_slot(columns: Sequence[str]) -> Column:
    """Slot of a natural key: a function of its value only, evenly spread whatever the key looks like."""
    digest = F.md5(F.concat_ws("|", *[F.col(name).cast("string") for name in columns]).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % KEY_SLOTS


def numbered(
    df: DataFrame, key_col: str, order_cols: Sequence[str], start_at: Column | int = 0, apart: Sequence[str] = ()
) -> DataFrame:
    """Add surrogate key ``key_col`` to rows identified by ``order_cols``.

    Rows are dealt to slots by a hash of their natural key and numbered inside the slot;
    key = start + (number - 1) * slots + slot + 1. Distinct rows get distinct keys, and the
    same rows get the same keys however the data is partitioned. It takes one evenly spread
    exchange: no global sort, no counting pass, no value carried through the driver.
    Groups of rows that differ in ``apart`` are numbered independently of each other.
    """
    order = [F.asc_nulls_first(name) for name in order_cols]
    place = F.row_number().over(Window.partitionBy(*apart, "_slot").orderBy(*order))
    start = start_at if isinstance(start_at, Column) else F.lit(start_at).cast("bigint")
    key = start + (F.col("_place").cast("bigint") - 1) * KEY_SLOTS + F.col("_slot") + 1
    placed = df.withColumn("_slot", key_slot(order_cols)).withColumn("_place", place)
    return placed.withColumn(key_col, key).drop("_slot", "_place")


def assign_surrogate_key(
    df: DataFrame, key_col: str, order_cols: Sequence[str], start_at: Column | int = 0
) -> DataFrame:
    """Put a surrogate key in front of the columns of ``df``; every key is above ``start_at``."""
    others = [name for name in df.columns if name != key_col]
    return numbered(df.select(*others), key_col, order_cols, start_at).select(key_col, *others)


def largest_key(df: DataFrame, key_col: str) -> DataFrame:
    """One row, one column: the largest key in use, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(key_col), F.lit(0)).cast("bigint").alias("max_key"))
