"""Connected components of a link table by alternating star steps, without gathering links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage


def _toward_smaller(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected(edges: DataFrame) -> DataFrame:
    """Columns ``node`` and ``root`` (smallest node reachable) for every node with a link to another one.

    ``edges`` has two columns of one comparable type, in any order and with repeats. Large-star and
    small-star steps alternate until the links no longer change: each node then points at its root.
    Stars are found by aggregation, so a node with very many links costs no large group.
    """
    a, b = edges.columns
    links = stage(_toward_smaller(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).dropna()), "links")
    before = _signature(links)
    while before[0]:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _toward_smaller(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stage(_toward_smaller(small.union(least.select("u", F.col("m").alias("v")))), "links")
        after = _signature(links)
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
