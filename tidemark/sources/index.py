"""The keys of a merged table, kept bucketed and sorted by key, so that a merge brings only its delta to them.

The index of a table is an external bucketed table of Spark's: its key columns, the columns a merge asks for (surrogate key, partition value) and
the number of the merge that wrote the row. A merge appends a row for every row it wrote; for a key those of its last merge count. Joins and
windows by key then find the index in place and shuffle the delta alone. After ``COMPACT_AFTER`` merges the index is written anew.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.files import Files

DATABASE = "tidemark_index"
COMPACT_AFTER = 8
#: Number of the merge that wrote an index row; not a column of any table.
WRITTEN = "_merge"


class KeyIndex:
    def __init__(
        self,
        spark: SparkSession,
        files: Files,
        base: str,
        layer: str,
        name: str,
        keys: Sequence[str],
        carried: Sequence[str],
        buckets: int,
    ):
        self.spark, self._files, self.keys, self.carried = spark, files, list(keys), list(carried)
        self._root = f"{base}/_index/{layer}.{name}"
        known = [entry for entry in files.names(self._root) if not entry.startswith("_")]
        # "<buckets>-<generation>": the last generation counts
        self._folder = max(known, key=lambda entry: int(entry.split("-")[1])) if known else f"{buckets}-0"
        self._name = hashlib.sha256(self._root.encode()).hexdigest()[:16]

    @staticmethod
    def forget(files: Files, base: str, layer: str, name: str) -> None:
        """Drop the index of a table that was replaced as a whole."""
        files.delete(f"{base}/_index/{layer}.{name}")
        files.delete(f"{base}/_index/{layer}.{name}.open")

    @property
    def _buckets(self) -> int:
        return int(self._folder.split("-")[0])

    @property
    def table(self) -> str:
        return f"{DATABASE}.i{self._name}_{self._folder.split('-')[1]}"

    def _quoted(self, names: Sequence[str]) -> str:
        return ", ".join(f"`{name}`" for name in names)

    def _create(self, rows: DataFrame) -> None:
        """Name the folder in this session's catalog, under its bucketing."""
        columns = ", ".join(f"`{entry.name}` {entry.dataType.simpleString()}" for entry in rows.schema)
        by = self._quoted(self.keys)
        place = f"{self._root}/{self._folder}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE} LOCATION '{self._root}/_database'")
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        self.spark.sql(
            f"CREATE TABLE {self.table} ({columns}) USING parquet OPTIONS (compression 'zstd') CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self._buckets} BUCKETS LOCATION '{place}'"
        )

    def _append(self, rows: DataFrame, merge: int) -> None:
        """Rows with a NULL key match nothing and are left out. One file per bucket."""
        named = rows.where(" AND ".join(f"`{key}` IS NOT NULL" for key in self.keys))
        dealt = named.select(*self.keys, *self.carried, F.lit(merge).alias(WRITTEN)).repartition(self._buckets, *self.keys)
        dealt.write.insertInto(self.table)
        self._refresh()

    def open(self, target: DataFrame) -> None:
        """Make the index usable; the keys are taken from the table itself at its first merge, and after a merge that did not end."""
        if self._files.exists(f"{self._root}.open"):
            self._files.delete(self._root)
            self._files.delete(f"{self._root}.open")
        whole = self._files.exists(f"{self._root}/{self._folder}/_SUCCESS")
        if not whole:
            self._files.delete(f"{self._root}/{self._folder}")
        self._create(target.select(*self.keys, *self.carried).withColumn(WRITTEN, F.lit(0)))
        if not whole:
            self._append(target, 0)

    def begin(self) -> None:
        """From here until ``add`` the index may lag behind the table."""
        self._files.touch(f"{self._root}.open")

    def _refresh(self) -> None:
        self.spark.catalog.refreshTable(self.table)

    def entries(self) -> DataFrame:
        return self.spark.table(self.table)

    def current(self) -> DataFrame:
        """What the last merge that wrote a key left: keys and carried columns. The keys lie bucketed, so nothing is moved."""
        last = F.max(WRITTEN).over(Window.partitionBy(*self.keys))
        rows = self.entries().withColumn("_last", last).where(F.col(WRITTEN) == F.col("_last"))
        return rows.select(*self.keys, *self.carried)

    def largest(self, column: str) -> int:
        return self.entries().agg(F.coalesce(F.max(column), F.lit(0)).cast("bigint")).first()[0]

    def add(self, rows: DataFrame) -> None:
        """Note what a merge wrote; every now and then write the index anew."""
        merge = self.entries().agg(F.coalesce(F.max(WRITTEN), F.lit(0))).first()[0] + 1
        if merge < COMPACT_AFTER:
            self._append(rows, merge)
        else:
            self._compact(rows)
        self._files.delete(f"{self._root}.open")

    def _compact(self, rows: DataFrame) -> None:
        fresh = rows.select(*self.keys, *self.carried)
        whole = self.current().join(fresh, self.keys, "left_anti").unionByName(fresh)
        old, generation = self._folder, int(self._folder.split("-")[1]) + 1
        old_table, self._folder = self.table, f"{self._buckets}-{generation}"
        self._create(whole.withColumn(WRITTEN, F.lit(0)))
        self._append(whole, 0)
        self.spark.sql(f"DROP TABLE IF EXISTS {old_table}")
        self._files.delete(f"{self._root}/{old}")
