"""Key dimensions, type-2 history and the calendar."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expressions import day_number, differs, on_weekend
from tidemark.operators.dedup import distinct_values, latest_per_key
from tidemark.operators.keys import assign_surrogate_key, largest_key, numbered


def union_values(value_col: str, *sources: tuple[DataFrame, str]) -> DataFrame:
    """One column holding the values of several (frame, column) pairs, duplicates included."""
    parts = [frame.select(F.col(column).alias(value_col)) for frame, column in sources]
    return reduce(DataFrame.unionByName, parts)


def static_dimension(
    values: DataFrame,
    value_col: str,
    key_col: str,
    existing: DataFrame | None = None,
    start_at: Column | int | None = None,
) -> DataFrame:
    """(key, value) rows: known values keep their key, unseen ones get keys above ``start_at``, the largest known if not given."""
    seen = distinct_values(values, value_col)
    if existing is None:
        return assign_surrogate_key(seen, key_col, [value_col])
    known = existing.groupBy(value_col).agg(F.min(key_col).alias(key_col)).select(key_col, value_col)
    unseen = seen.join(known, value_col, "left_anti")
    start = largest_key(existing, key_col).scalar() if start_at is None else start_at
    return known.unionByName(assign_surrogate_key(unseen, key_col, [value_col], start))


def scd2_changes(
    source: DataFrame, current: DataFrame, natural_key: str, attributes: Sequence[str]
) -> DataFrame:
    """Source rows that need a new version, with ``change_type`` new or changed."""
    marks = current.select(natural_key, F.struct(*attributes).alias("_was"), F.lit(True).alias("_known"))
    rows = source.select(natural_key, *attributes).join(marks, natural_key, "left")
    changed = differs([F.col(a) for a in attributes], [F.col(f"_was.{a}") for a in attributes])
    kind = F.when(F.col("_known").isNull(), "new").when(changed, "changed")
    return rows.withColumn("change_type", kind).where("change_type IS NOT NULL").drop("_was", "_known")


def scd2_dimension(
    source: DataFrame,
    natural_key: str,
    surrogate_key: str,
    attributes: Sequence[str],
    process_ts: str,
    existing: DataFrame | None = None,
    start_at: Column | int | None = None,
) -> DataFrame:
    """Type-2 history: changed keys close their open version at ``process_ts`` and open a new one.

    Keys absent from the source stay as they are. Columns: surrogate key, natural key,
    attributes, effective_from, effective_to, is_current. New keys lie above ``start_at``, the largest
    key in ``existing`` if not given.

    All versions meet the source once, in a full outer join; each pair then fans out to the rows it leaves: the version as it
    was or closed, and the one it opens.
    """
    stamp = F.lit(process_ts).cast("timestamp")
    layout = [surrogate_key, natural_key, *attributes, "effective_from", "effective_to", "is_current"]
    rows = latest_per_key(source.select(natural_key, *attributes), [natural_key], newest_first=())
    if existing is None:
        keyed = assign_surrogate_key(rows, surrogate_key, [natural_key], 0)
        span = {"effective_from": stamp, "effective_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True)}
        return keyed.withColumns(span).select(*layout)

    was = existing.select(*[F.col(name).alias(f"_was_{name}") for name in layout], F.lit(True).alias("_stored"))
    now = rows.select(*[F.col(name).alias(f"_now_{name}") for name in (natural_key, *attributes)], F.lit(True).alias("_given"))
    # A closed version meets nothing and passes through; a key without an open one comes in as new.
    meets = (F.col(f"_was_{natural_key}") == F.col(f"_now_{natural_key}")) & F.col("_was_is_current")
    pairs = was.join(now, meets, "full_outer")
    stored, given = F.col("_stored").isNotNull(), F.col("_given").isNotNull()
    changed = stored & given & differs([F.col(f"_now_{a}") for a in attributes], [F.col(f"_was_{a}") for a in attributes])
    types = {entry.name: entry.dataType for entry in existing.select(*layout).schema}

    def version(values: dict[str, Column]) -> Column:
        return F.struct(*[values[name].cast(types[name]).alias(name) for name in layout])

    kept = version(
        {name: F.col(f"_was_{name}") for name in layout}
        | {
            "effective_to": F.when(changed, stamp).otherwise(F.col("_was_effective_to")),
            "is_current": F.when(changed, F.lit(False)).otherwise(F.col("_was_is_current")),
        }
    )
    opened = version(
        {name: F.col(f"_now_{name}") for name in (natural_key, *attributes)}
        | {surrogate_key: F.lit(None), "effective_from": stamp, "effective_to": F.lit(None), "is_current": F.lit(True)}
    )
    left = F.array_compact(F.array(F.when(stored, kept), F.when(given & (~stored | changed), opened)))
    versions = pairs.select(F.explode(left).alias("_version")).select("_version.*")
    start = largest_key(existing, surrogate_key).scalar() if start_at is None else start_at
    versions = versions.withColumn("_is_new", F.col(surrogate_key).isNull())
    placed = numbered(versions, "_fresh", [natural_key], start, apart=["_is_new"])
    return placed.withColumn(surrogate_key, F.coalesce(surrogate_key, "_fresh")).select(*layout)


def date_bounds(dates: DataFrame, column: str) -> DataFrame:
    """One row with the first and last date."""
    return dates.agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"))


def calendar(spark: SparkSession, dates: DataFrame, column: str) -> DataFrame:
    """One row per day from the first to the last date in ``dates``; an error if there is none.

    Only the two bounds reach the driver. The days come from ``spark.range``, whose size Spark
    knows exactly, so a later lookup against the calendar is planned from its true size.
    """
    first, last = date_bounds(dates, column).first()
    if first is None:
        raise ValueError("no date in any input: cannot bound the calendar")
    days = spark.range((last - first).days + 1)
    return days.select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("full_date")).select(
        day_number("full_date").alias("date_key"),
        "full_date",
        F.dayofmonth("full_date").alias("day"),
        F.month("full_date").alias("month"),
        F.quarter("full_date").alias("quarter"),
        F.year("full_date").alias("year"),
        on_weekend("full_date").alias("is_weekend"),
    )
