"""Stored tables of the three layers, as Parquet folders whose partitions Spark itself replaces.

A table is a folder, partitioned by one column or not at all. Partitions are replaced by Spark's dynamic partition overwrite: files are
written aside and take the place of the old ones when the job commits, so rows may be computed from the very partitions they
replace, and a job that fails leaves them as they were. An unpartitioned table is written aside as a whole and then put in the old one's place.
Next to the tables lies, for each, an empty Parquet file with its columns: the declared schema, under which all its partitions are read, older ones
without a later column included.

One writer per table at a time. A driver that dies during a commit may leave partitions to be replaced again: run the step again; loads and merges
then give the same result. A text partition value that is empty is NULL, as Spark stores it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.operators.keys import key_slot
from tidemark.operators.upsert import incoming_with_keys, matches, merge_rows
from tidemark.sources.files import Files
from tidemark.sources.index import KeyIndex
from tidemark.sources.statistics import bounds

#: What Spark calls the folder of a NULL partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
#: How tables are compressed: a third less on disk than Spark's default, for rows written once and read often.
CODEC = "zstd"
#: Up to so many partitions each task may write a file into every one of them; for more, rows are first brought together by partition.
FEW = 4
#: Bytes, as stored, that one job of a merge numbers or rewrites: what its shuffles hold on disk does not grow with the table.
AT_ONCE = 256 * 2**20
#: Column types that may widen from one delivery to the next; Parquet readers read the older files under the wider type.
WIDER: dict[DataType, tuple[DataType, ...]] = {
    IntegerType(): (LongType(), DoubleType()),
    FloatType(): (DoubleType(),),
}


class TableMissing(RuntimeError):
    """A table that has to be built first."""


class AmbiguousMerge(ValueError):
    """Several source rows would update one target row."""


class DriftedType(ValueError):
    """A column arrived with a type its stored rows cannot be read under."""


def wider_schema(known: StructType, new: StructType) -> StructType:
    """All columns of both, the known ones first; a column of two types takes the wider one."""
    found = {entry.name: entry.dataType for entry in new}
    out = []
    for entry in known:
        old, now = entry.dataType, found.pop(entry.name, entry.dataType)
        if old != now and now in WIDER.get(old, ()):
            old = now
        elif old != now and old not in WIDER.get(now, ()):
            raise DriftedType(f"column {entry.name} was {old.simpleString()} and is now {now.simpleString()}")
        out.append(StructField(entry.name, old))
    return StructType([*out, *[StructField(name, kind) for name, kind in found.items()]])


class TableStore:
    """Tables under ``base``, addressed by layer and name.

    ``index_buckets`` is the number of buckets of the key indexes of merged tables, the session's shuffle partitions if not given; an index
    keeps the number it began with.
    """

    def __init__(self, spark: SparkSession, base: str, index_buckets: int | None = None):
        self.spark = spark
        self.base = base.rstrip("/")
        self._files = Files(spark)
        self._index_buckets = index_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def path(self, layer: str, name: str) -> str:
        return f"{self.base}/{layer}/{name}"

    # -------------------------------------------------------------- bronze

    def add_bronze(self, name: str, rows: DataFrame, mode: str = "replace", ingest_date: str | None = None) -> None:
        """Store one delivery under its ``ingest_date``.

        ``replace`` makes a repeated load of a date idempotent; ``append`` adds the rows again. With ``ingest_date`` given, a delivery that
        comes again without rows empties its date. Columns may be added or widen from one delivery to the next.
        """
        if mode not in ("replace", "append"):
            raise ValueError("bronze mode must be one of: append, replace")
        known = self.schema("bronze", name)
        own = [entry for entry in rows.schema if entry.name != "ingest_date"]
        schema = StructType([*own, StructField("ingest_date", StringType())])
        schema = schema if known is None else wider_schema(known, schema)
        path = self.path("bronze", name)
        if mode == "append":
            rows.write.mode("append").partitionBy("ingest_date").parquet(path, compression=CODEC)
        else:
            self._replace_partitions(path, rows, "ingest_date", [] if ingest_date is None else [ingest_date])
        self._declare("bronze", name, schema)

    def bronze(self, name: str, ingest_date: str | None = None) -> DataFrame:
        """Bronze rows of all deliveries, or of one ``ingest_date`` (only that partition is read)."""
        schema = self.schema("bronze", name)
        if schema is None:
            raise TableMissing(f"bronze.{name} does not exist; load it first")
        rows = self._scan("bronze", name, schema)
        return rows if ingest_date is None else rows.where(F.col("ingest_date") == ingest_date)

    def delivery_dates(self, name: str) -> list[str]:
        """All dates a bronze table was delivered for, from its folders."""
        path = self.path("bronze", name)
        return sorted(unquote(folder) for folder in self._partition_files(path, "ingest_date"))

    # -------------------------------------------------------- silver and gold

    def schema(self, layer: str, name: str) -> StructType | None:
        """The declared columns of a table; None if there is no such table."""
        path = self._schema_path(layer, name)
        if written := self._files.written_schema(path):
            fields = StructType.fromJson(json.loads(written)).fields
            return StructType([StructField(entry.name, entry.dataType) for entry in fields])
        try:
            return self.spark.read.parquet(path).schema
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def exists(self, layer: str, name: str) -> bool:
        return self._files.exists(self._schema_path(layer, name))

    def read(self, layer: str, name: str) -> DataFrame:
        schema = self.schema(layer, name)
        if schema is None:
            raise TableMissing(f"{layer}.{name} does not exist; build it first")
        return self._scan(layer, name, schema)

    def read_if_exists(self, layer: str, name: str) -> DataFrame | None:
        schema = self.schema(layer, name)
        return None if schema is None else self._scan(layer, name, schema)

    def bounds(self, layer: str, name: str, columns: Sequence[str]) -> dict[str, tuple]:
        """Smallest and largest value of stored columns, from file footers where Spark can."""
        schema = self.schema(layer, name)
        if schema is None:
            raise TableMissing(f"{layer}.{name} does not exist; build it first")
        path = self.path(layer, name)
        return bounds(self.spark, path, schema, columns) if self._files.exists(path) else dict.fromkeys(columns, (None, None))

    def has_few_partitions(self, layer: str, name: str) -> bool:
        by = self.partition_column(layer, name)
        return by is not None and len(self._partition_files(self.path(layer, name), by)) <= FEW

    def partition_column(self, layer: str, name: str) -> str | None:
        """What a stored table is partitioned by."""
        folders = [entry for entry in self._files.names(self.path(layer, name)) if "=" in entry]
        return folders[0].split("=", 1)[0] if folders else None

    def overwrite(
        self, layer: str, name: str, rows: DataFrame, partition_by: str | None = None, few_partitions: bool = False
    ) -> None:
        """Replace a table; ``rows`` may be derived from its present content.

        With ``few_partitions`` rows fall into at most ``FEW`` partitions and are written as they lie, without an exchange.
        """
        by = partition_by if partition_by in rows.columns else None
        schema, path = rows.schema, self.path(layer, name)
        if by is None or self.partition_column(layer, name) not in (None, by):
            staging = self._staging(layer, name)
            self._written(rows, by, staging, few_partitions)
            self._files.replace(staging, path)
        else:
            # Rebalancing gathers each partition's rows into well-sized files and splits big partitions.
            before = self._partition_files(path, by)
            dealt = rows if few_partitions else rows.hint("rebalance", by)
            dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path, compression=CODEC)
            for folder in self._left_alone(path, by, before):
                self._files.delete(f"{path}/{by}={folder}")
        if by is not None and self.partition_column(layer, name) is None:
            self._clear(path, by, schema, [NULL_FOLDER])
        self._declare(layer, name, schema)
        KeyIndex.forget(self._files, self.base, layer, name)

    def replace_partitions(self, layer: str, name: str, rows: DataFrame, by: str, few_partitions: bool = False) -> None:
        """Put ``rows`` in the place of the partitions they fall into; all others stay. Not for tables that are also merged."""
        known = self.schema(layer, name)
        schema = rows.schema if known is None else wider_schema(known, rows.schema)
        self._replace_partitions(self.path(layer, name), rows if few_partitions else rows.hint("rebalance", by), by, [])
        self._declare(layer, name, schema)

    def upsert(
        self,
        layer: str,
        name: str,
        rows: DataFrame | Sequence[DataFrame],
        keys: Sequence[str],
        surrogate_col: str | None = None,
        partition_by: str | None = None,
        few_partitions: bool = False,
    ) -> None:
        """Merge ``rows`` on ``keys``; the first write stores them as they are, ``few_partitions`` as in ``overwrite``.

        Several frames are the parts of one source, computed one after another.

        With ``surrogate_col`` known rows keep their surrogate key and new rows get one above the largest. The rows are staged, so that they
        are computed once. They meet the table's keys once, in the key index, where it is bucketed by them; what they find there is staged
        too and tells the rows to refuse, the partitions to rewrite and the surrogate keys to keep.
        """
        schema = self.schema(layer, name)
        if schema is None:
            whole = rows if isinstance(rows, DataFrame) else reduce(DataFrame.unionByName, rows)
            self.overwrite(layer, name, whole, partition_by, few_partitions)
            return
        keys, by = list(keys), self.partition_column(layer, name)
        target = self._scan(layer, name, schema)
        staging = self._staging(layer, name)
        delta = self._staged(rows, f"{staging}/delta")

        carried = [column for column in (surrogate_col, by) if column is not None]
        index = KeyIndex(self.spark, self._files, self.base, layer, name, keys, carried, self._index_buckets)
        index.open(target)
        found = self._staged(matches(index.current(), delta, keys), f"{staging}/found")
        if not found.where("_times > 1").isEmpty():
            raise AmbiguousMerge(f"{layer}.{name}: several rows with one key on ({', '.join(keys)})")

        incoming, touched = delta, []
        if by is not None:
            # One value per partition the merge touches: as many as Spark itself lists to replace them, at most.
            values = found.select(by).union(delta.select(by)).distinct()
            touched = [tuple(row) for row in values.select(by, F.col(by).cast("string")).collect()]
        if surrogate_col:
            start = index.largest(surrogate_col)
            # Rows of a key slot are numbered together, so the slots can be dealt to jobs that run one after another.
            incoming = self._staged(
                [
                    incoming_with_keys(delta.where(share), found.where(share), keys, surrogate_col, start)
                    for share in shares(key_slot(keys), jobs_for(self._files.size(f"{staging}/delta")))
                ],
                f"{staging}/incoming",
            )
            self._files.delete(f"{staging}/delta")
        merged_schema = wider_schema(schema, incoming.schema)
        index.begin()
        if by is None:
            self._files.delete(f"{staging}/found")
            self._written(merge_rows(target, incoming, keys), None, f"{staging}/merged")
            self._files.replace(f"{staging}/merged", self.path(layer, name))
        else:
            # A merge that fills up columns from the rows it replaces reads all of them: it is not cut.
            whole = not set(target.columns) <= set(incoming.columns)
            path, added = self.path(layer, name), self._files.size(f"{staging}/{'incoming' if surrogate_col else 'delta'}")
            for group in [touched] if whole else self._in_groups(path, by, touched, added):
                here = one_of(by, [value for value, _ in group])
                merged = merge_rows(target.where(here), incoming if whole else incoming.where(here), keys, found.where(here))
                dealt = merged if len(touched) <= FEW else merged.hint("rebalance", by)
                self._replace_partitions(path, dealt, by, [text or NULL_FOLDER for _, text in group])
        index.add(incoming)
        self._declare(layer, name, merged_schema)
        self._files.delete(staging)

    @contextmanager
    def staged(self, layer: str, name: str, rows: DataFrame | Sequence[DataFrame]) -> Iterator[DataFrame]:
        """Inside, ``rows`` as stored aside: computed once, and without the shuffles they came from; several frames one after another."""
        staging = self._staging(layer, name)
        try:
            yield self._staged(rows, staging)
        finally:
            self._files.delete(staging)

    def bytes_under(self, *paths: str) -> int:
        """Bytes of files and folders together, compressed as they lie."""
        return sum(self._files.size(path) for path in paths)

    # ------------------------------------------------------------------ helpers

    def _staging(self, layer: str, name: str) -> str:
        return f"{self.base}/_staging/{layer}.{name}-{uuid.uuid4().hex}"

    def _schema_path(self, layer: str, name: str) -> str:
        return f"{self.base}/_schemas/{layer}/{name}"

    def _declare(self, layer: str, name: str, schema: StructType) -> None:
        plain = StructType([StructField(entry.name, entry.dataType) for entry in schema])
        if self.schema(layer, name) != plain:
            empty = self.spark.createDataFrame([], plain).coalesce(1)
            empty.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self._schema_path(layer, name))

    def _scan(self, layer: str, name: str, schema: StructType) -> DataFrame:
        path = self.path(layer, name)
        if not self._files.exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path).select(*[f"`{column}`" for column in schema.names])

    def _staged(self, rows: DataFrame | Sequence[DataFrame], path: str) -> DataFrame:
        parts = [rows] if isinstance(rows, DataFrame) else rows
        for part in parts:
            part.write.mode("append").parquet(path, compression=CODEC)
        return self.spark.read.schema(parts[0].schema).parquet(path)

    def _written(self, rows: DataFrame, by: str | None, path: str, few_partitions: bool = False) -> None:
        if by is None:
            rows.write.parquet(path, compression=CODEC)
        else:
            (rows if few_partitions else rows.hint("rebalance", by)).write.partitionBy(by).parquet(path, compression=CODEC)

    def _replace_partitions(self, path: str, rows: DataFrame, by: str, wanted: Sequence[str]) -> None:
        """Put ``rows`` in the place of the partitions they fall into; those of ``wanted`` that get no row are emptied.

        ``rows`` may read the partitions they replace.
        """
        before = self._partition_files(path, by, set(wanted))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path, compression=CODEC)
        self._clear(path, by, rows.schema, self._left_alone(path, by, before))

    def _partition_files(self, path: str, by: str, wanted: set[str] | None = None) -> dict[str, list[str]]:
        folders = [entry.split("=", 1)[1] for entry in self._files.names(path) if entry.startswith(f"{by}=")]
        return {folder: self._files.names(f"{path}/{by}={folder}") for folder in folders if wanted is None or unquote(folder) in wanted}

    def _in_groups(self, path: str, by: str, touched: Sequence[tuple], added: int) -> list[list[tuple]]:
        """The (value, text) of ``touched`` partitions in groups of about ``AT_ONCE`` bytes; ``added`` bytes fall evenly on all."""
        folders = {unquote(entry.split("=", 1)[1]): entry for entry in self._files.names(path) if entry.startswith(f"{by}=")}
        groups, room = [], 0
        for value, text in sorted(touched, key=lambda pair: pair[1] or ""):
            folder = folders.get(text or NULL_FOLDER)
            size = (self._files.size(f"{path}/{folder}") if folder else 0) + added // len(touched)
            if not groups or size > room:
                groups.append([])
                room = AT_ONCE
            groups[-1].append((value, text))
            room -= size
        return groups

    def _left_alone(self, path: str, by: str, before: dict[str, list[str]]) -> list[str]:
        """Partitions a write put no row into: Spark's files have new names in every job, and these have their old ones."""
        return [folder for folder, files in before.items() if self._files.names(f"{path}/{by}={folder}") == files]

    def _clear(self, path: str, by: str, schema: StructType, folders: Sequence[str]) -> None:
        """Leave partitions with an empty file."""
        empty = self.spark.createDataFrame([], StructType([entry for entry in schema if entry.name != by])).coalesce(1)
        for folder in folders:
            empty.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{by}={folder}")


def jobs_for(size: int) -> int:
    """How many jobs take ``size`` stored bytes."""
    return max(1, -(-size // AT_ONCE))


def shares(number: Column, jobs: int) -> list[Column]:
    """Conditions that deal rows to ``jobs`` by a number of theirs; a row without one goes to the first."""
    place = F.coalesce(F.pmod(number, F.lit(jobs)), F.lit(0))
    return [place == F.lit(job) for job in range(jobs)] if jobs > 1 else [F.lit(True)]


def one_of(column: str, values: Sequence) -> Column:
    """Whether ``column`` has one of ``values``, NULL included."""
    named = [value for value in values if value is not None]
    condition = F.col(column).isin(named) if named else F.lit(False)
    return condition | F.col(column).isNull() if len(named) < len(values) else condition
