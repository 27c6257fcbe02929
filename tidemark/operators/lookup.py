"""Key lookups and delta restrictions.

No join here carries a broadcast hint. Spark broadcasts a side when its known size is under
``spark.sql.autoBroadcastJoinThreshold`` (gold tables are files, so the size is known) and
otherwise sorts and merges, with adaptive execution splitting hot keys, NULLs included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_dimension_key(
    df: DataFrame, source_col: str, dimension: DataFrame, value_col: str, key_col: str, out_col: str
) -> DataFrame:
    """Add ``out_col``, the key of the dimension row whose value equals ``source_col``, else NULL."""
    lookup = dimension.select(F.col(value_col).alias(source_col), F.col(key_col).alias(out_col))
    return df.join(lookup, source_col, "left")


def attach_current(df: DataFrame, dimension: DataFrame, natural_key: str, *columns: str) -> DataFrame:
    """Left-join columns of the current version of a type-2 dimension."""
    return df.join(current_versions(dimension).select(natural_key, *columns), natural_key, "left")


def current_versions(dimension: DataFrame) -> DataFrame:
    return dimension.where("is_current")


def valid_rows(silver: DataFrame) -> DataFrame:
    return silver.where("validation_errors IS NULL")


def restrict_to(df: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``delta``; repeats in ``delta`` do not multiply rows."""
    return df.join(delta.select(key), key, "left_semi")


def with_session_customer(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Events of known sessions with the session's customer; the rest vanish."""
    return events.join(sessions.select("session_id", "customer_id"), "session_id")
