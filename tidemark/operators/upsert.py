"""Merging rows into a table, with or without keeping surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keys import largest_key, numbered


def merge_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], matched_on: DataFrame | None = None
) -> DataFrame:
    """Upsert: matched rows take the source's columns, unmatched source rows are added.

    Keys match by SQL equality, so a NULL key matches nothing. Columns only the source has
    are added to the table; columns only the target has keep their value on a match.
    ``matched_on`` may supply the source's keys from a cheaper frame than the source itself.
    """
    keys = list(keys)
    kept = target.join((source if matched_on is None else matched_on).select(*keys), keys, "left_anti")
    target_only = [name for name in target.columns if name not in source.columns]
    if target_only:
        source = source.join(target.select(*keys, *target_only), keys, "left")
    return kept.unionByName(source, allowMissingColumns=True).select(
        *target.columns, *[name for name in source.columns if name not in target.columns]
    )


def ambiguous_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once in the source and also in the target: a merge must refuse them."""
    repeated = source.groupBy(*keys).count().where("count > 1").drop("count")
    return repeated.join(target.select(*keys), list(keys), "left_semi")


def matches(index: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The entries of a key index that ``source`` meets, with ``_times``, how often it has the key.

    The index is read once. Where it is stored bucketed by ``keys``, only ``source`` is shuffled.
    """
    wanted = source.groupBy(*keys).agg(F.count("*").alias("_times"))
    return index.join(wanted, list(keys))


def incoming_with_keys(
    delta: DataFrame, found: DataFrame, keys: Sequence[str], surrogate_col: str, start: Column | int
) -> DataFrame:
    """``delta`` with the surrogate key of ``found`` where the business key is known, one above ``start`` otherwise."""
    keys = list(keys)
    known = found.groupBy(*keys).agg(F.min(surrogate_col).alias("_known"))
    columns = [name for name in delta.columns if name != surrogate_col]
    rows = delta.select(*columns).join(known, keys, "left")
    rows = rows.withColumn("_is_new", F.col("_known").isNull())
    rows = numbered(rows, "_fresh", keys, start, apart=["_is_new"])
    return rows.select(F.coalesce("_known", "_fresh").alias(surrogate_col), *columns)


def keep_surrogates(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], surrogate_col: str
) -> DataFrame:
    """``incoming`` with the target's surrogate key where the business key is known, a new one otherwise.

    New keys lie above the largest key in the target. Of the target only the keys are read,
    and only those that occur in ``incoming`` are grouped.
    """
    known = target.select(*keys, surrogate_col).join(incoming.select(*keys), list(keys), "left_semi")
    start = largest_key(target, surrogate_col).scalar()
    return incoming_with_keys(incoming, known, keys, surrogate_col, start)


def merge_keep_surrogate(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], surrogate_col: str
) -> DataFrame:
    """Upsert that never renumbers a row already in the target."""
    source = keep_surrogates(target, incoming, keys, surrogate_col)
    return merge_rows(target, source, keys, matched_on=incoming)
