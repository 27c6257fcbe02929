"""What comes next inside a group, without putting a whole group into one task.

A session may hold a large share of all events. Both operators cut groups into time slots,
work inside (group, slot), and carry values across slot borders through a summary with one
row per (group, slot). Results equal those of a window over the whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# A window holds what one group emits within a slot. Shorter slots mean smaller windows and
# a longer summary; five minutes leave ordinary sessions with a handful of summary rows.
SLOT_SECONDS = 300


def _second(ts: str) -> Column:
    return F.col(ts).cast("bigint")


def _slot(ts: str) -> Column:
    return F.floor(_second(ts) / F.lit(SLOT_SECONDS)).cast("bigint")


#: The slot of rows without a time, below all others.
UNTIMED = -(2**62)


def seconds_to_next(df: DataFrame, group: str, ts: str, tie: str, out: str, owners: DataFrame | None = None) -> DataFrame:
    """Add the whole seconds to the next row of the group by (ts, tie); 0.0 for the last row.

    Both ends are cut to whole seconds before subtracting. With ``owners``, rows whose group occurs there are kept and take its
    columns, as by an inner join on ``group``; they come with the summary, so that the rows themselves are not shuffled by group.
    """
    slotted = df.withColumn("_slot", F.coalesce(_slot(ts), F.lit(UNTIMED)))
    starts = slotted.groupBy(group, "_slot").agg(F.min(_second(ts)).alias("_start"))
    after = starts.select(
        group,
        "_slot",
        F.lead("_start").over(Window.partitionBy(group).orderBy("_slot")).alias("_after"),
    )
    if owners is not None:
        after = after.join(owners, group)
    inside = F.lead(_second(ts)).over(Window.partitionBy(group, "_slot").orderBy(ts, tie))
    gap = F.coalesce("_inside", "_after") - _second(ts)
    return (
        slotted.withColumn("_inside", inside)
        .join(after, [group, "_slot"], "left" if owners is None else "inner")
        .withColumn(out, F.greatest(F.coalesce(gap, F.lit(0)), F.lit(0)).cast("double"))
        .drop("_slot", "_inside", "_after")
    )


def first_at_or_after(
    points: DataFrame, marks: DataFrame, group: str, point_ts: str, mark_ts: str
) -> DataFrame:
    """Add ``mark_ts``, the earliest mark of the point's group not before the point, else NULL.

    Linear in points plus marks: the two are merged in time order and the nearest mark is
    carried backwards, so no pairs are formed.
    """
    at_points = points.select(
        "*", F.col(point_ts).alias("_ts"), F.lit(None).cast("timestamp").alias(mark_ts)
    )
    at_marks = marks.select(group, mark_ts).distinct().withColumn("_ts", F.col(mark_ts))
    merged = at_points.unionByName(at_marks, allowMissingColumns=True).withColumn("_slot", _slot("_ts"))

    backwards = Window.partitionBy(group).orderBy(F.desc("_slot"))
    later = (
        merged.groupBy(group, "_slot")
        .agg(F.min(mark_ts).alias("_first"))
        .select(
            group,
            "_slot",
            F.min("_first")
            .over(backwards.rowsBetween(Window.unboundedPreceding, -1))
            .alias("_later"),
        )
    )
    # At equal times marks come first, so that a mark at the very time of a point counts.
    inside = Window.partitionBy(group, "_slot").orderBy(F.desc("_ts"), F.desc_nulls_last(mark_ts))
    nearest = F.min(mark_ts).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        merged.withColumn("_nearest", nearest)
        .where(F.col(mark_ts).isNull())
        .join(later, [group, "_slot"], "left")
        .withColumn(mark_ts, F.coalesce("_nearest", "_later"))
        .drop("_ts", "_slot", "_nearest", "_later")
    )
