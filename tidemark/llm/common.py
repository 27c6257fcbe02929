"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shuffles_dropped
from tidemark.sources.workspace import fresh_folder

#: Blanks that end a word: space and U+0009 to U+000D.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")
#: Upper-case A-Z only, whatever the locale says about other letters.
LOWER = {code: code + 32 for code in range(65, 91)}
#: Texts are handed to numpy in pieces of about this many bytes, so that memory does not follow the batch size.
PIECE_BYTES = 4 << 20

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this library where the driver was started from another folder."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stage(frame: DataFrame, label: str) -> DataFrame:
    """Write ``frame`` to the shared folder and read it back: cuts lineage and survives lost executors. Its shuffle files go with the write."""
    spark = frame.sparkSession
    path = fresh_folder(spark, label)
    with shuffles_dropped(spark):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def portions(texts: list[str | None] | pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of ``texts`` that hold about ``limit`` characters (of an Arrow array: bytes) each; a longer text stands alone."""
    start, size = 0, 0
    lengths = pc.binary_length(texts).fill_null(0).to_pylist() if isinstance(texts, pa.Array) else [len(text) if text else 0 for text in texts]
    for i, length in enumerate(lengths):
        if i > start and size + length > limit:
            yield start, i
            start, size = i, 0
        size += length
    if start < len(texts):
        yield start, len(texts)


def batch_of(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


#: Rows of texts that pass between Spark and a Python worker at once.
BATCH_ROWS = 1024
#: What empties the memories workers keep from task to task.
KEPT: list[Callable[[], None]] = []


def small_batches(spark: SparkSession) -> SparkSession:
    """Let texts pass to Python workers in batches of at most ``BATCH_ROWS``; each batch lies in memory several times over."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    return spark


def hand_back() -> None:
    """Drop what tasks of other operators keep in this worker, and give the memory they freed back to the machine, where its C library can."""
    for drop in KEPT:
        drop()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Runs:
    """Cuts a stream of Arrow batches sorted by some columns into groups of whole runs of equal keys."""

    def __init__(self, keys: list[str]):
        self.keys = keys

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cut = self._last_start(batch)
            if held and (cut > 0 or not self._same(held[-1], batch)):
                head = batch.slice(0, cut) if self._same(held[-1], batch) else batch.slice(0, 0)
                yield pa.Table.from_batches([*held, head])
                held, batch, cut = [], batch.slice(head.num_rows), cut - head.num_rows
            if cut > 0:
                yield pa.Table.from_batches([batch.slice(0, cut)])
                batch = batch.slice(cut)
            held.append(batch)
        if held:
            yield pa.Table.from_batches(held)

    def _same(self, a: pa.RecordBatch, b: pa.RecordBatch) -> bool:
        return all(a.column(k)[a.num_rows - 1].as_py() == b.column(k)[0].as_py() for k in self.keys)

    def _last_start(self, batch: pa.RecordBatch) -> int:
        """Where the last run of ``batch`` begins."""
        start = 0
        for k in self.keys:
            values = batch.column(k).to_numpy(zero_copy_only=False)
            differs = np.flatnonzero(values[1:] != values[:-1])
            if len(differs):
                start = max(start, int(differs[-1]) + 1)
        return start


def largest_classes(frame: DataFrame, column: str, limit: int) -> DataFrame:
    """The rows with the largest values of ``column``, in whole classes of equal values, as many as fit in ``limit`` rows.

    The bound of the values is found by counting, first by order of magnitude, then by value, so the caller may collect the rows: there are at
    most ``limit`` in all, whatever the number of partitions. A class that does not fit as a whole is left out.
    """
    value = F.col(f"`{column}`")
    # four steps to a doubling, on either side of zero
    step = F.signum(value) * F.floor(F.log2(F.abs(value) + 1) * 4)
    bins = sorted(((r[0], r[1]) for r in frame.groupBy(step.alias("bin")).count().collect()), reverse=True)
    have = 0
    for step_number, n in bins:
        if have + n > limit:
            break
        have += n
    else:
        return frame
    within = sorted(((r[0], r[1]) for r in frame.where(step == step_number).groupBy(value.alias("value")).count().collect()), reverse=True)
    least = None
    for number, n in within:
        if have + n > limit:
            break
        have, least = have + n, number
    return frame.where(step > step_number if least is None else (step > step_number) | (value >= least))


def run_bounds(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys, and the end."""
    n = len(keys[0])
    if n == 0:
        return np.zeros(1, dtype=np.int64)
    new = np.ones(n, dtype=bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(new), n)


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file, the same on every machine of the cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)
