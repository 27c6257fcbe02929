"""Session settings the library is written for."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tidemark.sources.files import Files

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split even where that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str, **extra: str) -> SparkSession:
    """A session with the library's settings; ``extra`` entries win over them."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Input one shuffle partition stands for. Derived rows take about four times the bytes of their Parquet input in a shuffle; adaptive
#: execution joins partitions that stay small.
INPUT_PER_PARTITION = 4 * 2**20
#: Shuffled bytes, compressed, that adaptive execution joins for one task at most, and bytes of a file one task reads; sorted or grouped
#: rows take some ten times as much memory.
TASK_SHARE = 16 * 2**20
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
SPLIT = "spark.sql.files.maxPartitionBytes"
#: Estimated bytes up to which a side of a join is broadcast unseen. The estimate counts a file's compressed bytes, and the driver holds the rows as a
#: hash table: some 14 times as much in rows, three times that while it is built.
BROADCAST_UNSEEN = 2 * 2**20
BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


def fit_shuffles(spark: SparkSession, paths: Sequence[str]) -> None:
    """Raise the session's shuffle partitions with the bytes to be read, so that what one task sorts does not grow with the input.

    More partitions, or smaller ones, than wanted stay as they are, and so does a lower threshold of broadcasts.
    """
    files = Files(spark)
    whole = spark.conf.get(BROADCAST)
    if not whole.startswith("-") and files.parsed_size(whole) > BROADCAST_UNSEEN:  # -1 is never
        spark.conf.set(BROADCAST, str(BROADCAST_UNSEEN))
    # Spark cuts small files into a share for each core, large ones into 128 MB: what a task reads would grow in between.
    for share in (ADVISORY, SPLIT):
        if files.parsed_size(spark.conf.get(share)) > TASK_SHARE:
            spark.conf.set(share, str(TASK_SHARE))
    wanted = -(-sum(files.size(path) for path in paths) // INPUT_PER_PARTITION)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, each write drops its shuffle files when it ends; otherwise they lie on disk until the driver collects garbage.

    Not for frames that are handed out: a second action on one of them would have to compute its shuffles again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
