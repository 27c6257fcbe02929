"""Mixing sources to target weights by hash-threshold histograms, with DataFrame operations only.

Every row gets a 60-bit hash of its id, which spreads a source's rows evenly over 4096 buckets. Words are summed by source and bucket
(an aggregation with partial sums; a hot source costs 4096 rows per task). A source that has target ``t`` and size
``S`` is taken whole ``floor(t / S)`` times and once more below a hash threshold for the rest. The bucket in which the rest is used
up is the only one looked into again, by the next twelve bits, until one hash is left. Rows are then filtered by comparing
their hash: nothing is sorted, and thresholds of growing budgets are nested.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
HASH_BITS = 60
LEVEL_BITS = 12


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long"), F.lit(0).cast("long"))


def spread(key: Column) -> Column:
    """60 bits that DuckDB can compute too: the first fifteen hex digits of the MD5 of the key as text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, share: float = 1.0) -> DataFrame:
    """Adds the column ``target`` to one row (source, source_size) per source.

    Sources by code point, null last, have the weights in turn. All sizes times ``share`` are dealt out by weight; what a source
    gets above ``most`` times its size goes to the others by weight until none is above. Sorted by how early they fill
    up, the full sources are a prefix, found by one running sum. The windows hold one row per source, no documents.
    """
    by_name, everywhere = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.get(F.array(*[F.lit(w).cast("long") for w in weights]), turn)
    rows = sizes.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("cap"))
    earlier = Window.orderBy(F.col("cap").cast("double") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "*",
        F.coalesce(F.sum("cap").over(earlier), F.lit(0)).alias("caps"),
        (F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))).alias("weights"),
        (F.sum("source_size").over(everywhere) if share == 1.0 else F.floor(F.sum("source_size").over(everywhere) * F.lit(share))).alias("total"),
    )
    full = F.col("cap").cast("double") * F.col("weights") < F.col("weight").cast("double") * (F.col("total") - F.col("caps"))
    rows = rows.withColumn("full", full)
    first_open = F.struct("caps", "weights")
    rest = F.min(F.when(~F.col("full"), first_open)).over(everywhere)  # of the first source that is not full: caps rise along the order
    rows = rows.withColumn("rest", rest)
    fair = (F.col("weight") * (F.col("total") - F.col("rest.caps"))).cast("double") / F.col("rest.weights")
    return rows.select("source", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(fair).alias("target"))


def sized(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """The slim rows that everything is computed from: doc_id, source, size, h."""
    return docs.select(F.col(id_column).alias("doc_id"), F.col(source_column).cast("string").alias("source"), words(F.col(text_column)).alias("size"), spread(F.col(id_column)).alias("h"))


def thresholds(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, share: float = 1.0) -> DataFrame:
    """One row per source: source, source_size, target, whole (times all is taken), cut (rows with h < cut once more)."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(sizes, weights, most, share)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = plan.withColumn("whole", whole)
    plan = plan.withColumn("need", F.col("target") - F.col("whole").cast("double") * F.col("source_size"))
    plan = plan.select("*", F.when(F.col("need") <= 0, F.lit(0).cast("long")).alias("cut"), F.lit(0).cast("long").alias("base"))
    plan = stage(plan, "mix-plan")
    at = plan.columns
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        pending = plan.where("cut IS NULL")
        if pending.isEmpty():
            break
        mine = pending.select(F.col("source").alias("s"), "base", "need")
        size = F.lit(1 << (shift + LEVEL_BITS)).cast("long")
        inside = rows.join(mine, F.col("source").eqNullSafe(F.col("s")) & (F.col("h") >= F.col("base")) & (F.col("h") < F.col("base") + size))
        buckets = inside.groupBy("s", "base", "need", F.shiftright(F.col("h") - F.col("base"), shift).alias("bucket"))
        buckets = buckets.agg(F.sum("size").alias("size"), F.min("h").alias("least"), F.max("h").alias("most"))
        running = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        buckets = buckets.withColumn("upto", F.sum("size").over(running)).where("upto > need")
        boundary = buckets.groupBy("s").agg(F.min(F.struct("bucket", "size", "least", "most", "upto")).alias("b"))
        joined = pending.join(boundary, F.col("source").eqNullSafe(F.col("s")), "left")
        left = F.col("need") - (F.col("b.upto") - F.col("b.size"))
        one = F.col("b.least") == F.col("b.most")
        # no bucket beyond the need: all rows belong; a single hash: it goes to the nearer side
        cut = F.when(F.col("b").isNull(), F.col("base") + size).when(one & (left >= F.col("b.size") / 2), F.col("b.most") + 1).when(one, F.col("b.least"))
        base = F.col("base") + F.shiftleft(F.coalesce(F.col("b.bucket"), F.lit(0).cast("long")), shift)
        found = joined.select("source", "source_size", "target", "whole", F.coalesce(left, "need").alias("need"), cut.alias("cut"), base.alias("base"))
        plan = stage(plan.where("cut IS NOT NULL").select(at).union(found.select(at)), "mix-plan")
    return plan.select("source", "source_size", "target", "whole", "cut")


def _copies(hash_: Column) -> Column:
    return F.col("__whole") + F.when(hash_ < F.col("__cut"), 1).otherwise(0)


def _marked(cuts: DataFrame) -> DataFrame:
    return cuts.select(F.col("source").alias("__source"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"), F.col("whole").alias("__whole"), F.col("cut").alias("__cut"))


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, share: float = 1.0) -> DataFrame:
    """What the mix takes of each row: doc_id, size, source_size, target, taken (words, repeats counted).

    Whole texts are taken, so a source's words miss its target by at most half its text at the threshold (texts with equal ids share one
    hash and go together). A null text has size 0, a null source is a source of its own, ids may be null. Empty input gives no rows.
    """
    rows = stage(sized(docs, id_column, text_column, source_column), "mix-sizes")
    cuts = _marked(thresholds(rows, weights, most, share))
    joined = rows.join(cuts, F.col("source").eqNullSafe(F.col("__source")))
    return joined.select("doc_id", "size", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), (F.col("size") * _copies(F.col("h"))).alias("taken"))


def take(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, share: float = 1.0) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken. Texts are not shuffled.

    Null texts have no words; a row whose size is 0 is taken as its hash says. Rows of one id go together. Other columns may have any name. An
    empty table gives an empty one.
    """
    rows = stage(sized(docs, id_column, text_column, source_column), "mix-sizes")
    cuts = _marked(thresholds(rows, weights, most, share))
    # the row travels as one column, so that its names meet none of these
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    own = docs.select(whole, F.col(source_column).cast("string").alias("own"), spread(F.col(id_column)).alias("h"))
    joined = own.join(cuts, F.col("own").eqNullSafe(F.col("__source"))).withColumn("__copies", _copies(F.col("h"))).where("__copies > 0")
    kept = joined.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


ORACLE = r"""
WITH rows AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source),
weighted AS (
  SELECT source, source_size, source_size * 3 AS cap,
    CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sizes),
running AS (
  SELECT *, CAST(coalesce(sum(cap) OVER w, 0) AS BIGINT) AS caps, CAST((SELECT sum(source_size) FROM sizes) AS BIGINT) AS total,
    CAST((SELECT sum(weight) FROM weighted) - coalesce(sum(weight) OVER w, 0) AS BIGINT) AS weights
  FROM weighted
  WINDOW w AS (ORDER BY CAST(cap AS DOUBLE) / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (SELECT *, CAST(cap AS DOUBLE) * weights < CAST(weight AS DOUBLE) * (total - caps) AS is_full FROM running),
open_ AS (SELECT caps AS open_caps, weights AS open_weights FROM marked WHERE NOT is_full ORDER BY caps, weights LIMIT 1),
targets AS (
  SELECT source, source_size, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE CAST(weight * (total - open_caps) AS DOUBLE) / open_weights END AS target
  FROM marked CROSS JOIN open_),
budgets AS (
  SELECT *, target - CAST(whole AS DOUBLE) * source_size AS need
  FROM (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets)),
hashes AS (
  SELECT source, h, g, sum(g) OVER (PARTITION BY source ORDER BY h ROWS UNBOUNDED PRECEDING) - g AS before
  FROM (SELECT source, h, sum(size) AS g FROM rows GROUP BY source, h))
SELECT r.doc_id, r.size, b.source_size, b.target,
  CAST(r.size * (b.whole + CASE WHEN b.need > 0 AND CAST(s.before AS DOUBLE) + CAST(s.g AS DOUBLE) / 2 <= b.need THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rows r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source
JOIN hashes s ON s.source IS NOT DISTINCT FROM r.source AND s.h = r.h
"""
