"""SimHash near-duplicates by covering locality-sensitive hashing.

A pair of 64-bit fingerprints that differ in at most three positions agrees, outside those positions,
on every mask that is zero there. Give each position a vector of four bits; mask ``v`` keeps the
positions whose vector has an odd product with ``v``. Three positions span at most three of four
dimensions, so one of the fifteen masks is zero on all of them: every pair within the radius
meets in some table, whatever the fingerprints are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, WORD_BYTES, Runs, hand_back, run_bounds, stage
from tidemark.llm.components import connected

BITS = 64
RADIUS = 3
SHINGLE_WORDS = 3
SEED = 42
#: Buckets above this many distinct fingerprints are covered once more on the positions their mask left out.
#: It decides how a pair is met, never whether.
WIDE_BUCKET = 1024


def covering_masks(positions: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over ``positions`` such that any ``radius`` of them are all left out by one mask."""
    size = 1 << (radius + 1)
    given = {p: 1 + i % (size - 1) for i, p in enumerate(positions)}
    return [sum(1 << p for p, m in given.items() if (m & v).bit_count() % 2) for v in range(1, size)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


MASKS = covering_masks(list(range(BITS)))
INNER_MASKS = [[mask | inner for inner in covering_masks([p for p in range(BITS) if not mask >> p & 1])] for mask in MASKS]


def fingerprint(text: str | None) -> int:
    """Majority of the shingle hashes, position by position; 0 for a text without words."""
    if not text:
        return 0
    words = WORD_BYTES.findall(text.translate(LOWER).encode("utf-8", "surrogatepass"))
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(SHINGLE_WORDS, len(words))
    begin, end = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    n = len(begin)
    hashes = np.fromiter((digest(joined[i:j], SEED) for i, j in zip(begin, end)), dtype=np.uint64, count=n)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 1 << 16):  # bits of one block at a time
        block = hashes[at : at + (1 << 16)].astype("<u8")
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(counts * 2 > n, bitorder="little")
    return int(majority.view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hand_back()
    for batch in batches:
        values = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), dtype=np.uint64, count=batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Columns doc_id and fp (the fingerprint's 64 bits as a signed long), one row per input row."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints, "doc_id long, fp long")


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def forest(values: np.ndarray, radius: int = RADIUS) -> tuple[list[int], list[int]]:
    """Links that join exactly the values reachable by steps of at most ``radius`` bits; fewer links than values."""
    open_ = values
    left, right = [], []
    while len(open_):
        front, open_ = open_[:1], open_[1:]
        while len(front) and len(open_):
            node, front = front[0], front[1:]
            near = _popcount(open_ ^ node) <= radius
            if near.any():
                found = open_[near]
                left += [int(node)] * len(found)
                right += found.tolist()
                front, open_ = np.concatenate((front, found)), open_[~near]
    return left, right


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for rows in Runs(["t", "k"])(batches):
        t, k, fp = (rows.column(c).to_numpy() for c in ("t", "k", "fp"))
        bounds = run_bounds(t, k)
        left, right = [], []
        for i in np.flatnonzero(np.diff(bounds) > 1):
            a, b = forest(fp[bounds[i] : bounds[i + 1]].view(np.uint64))
            left += a
            right += b
        if left:
            pair = [np.array(x, dtype=np.uint64).view(np.int64) for x in (left, right)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in pair], schema=schema)


def near_links(values: DataFrame, wide: int = WIDE_BUCKET) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct ``fp`` within the radius.

    Every value goes to fifteen tables. A bucket with more than ``wide`` values is dealt out again by
    fifteen masks over the positions it does not fix; about 14 stay free then, so no group
    outgrows 2^14 or so distinct values at any corpus size. In a group only a spanning forest is written.
    """
    masks = F.array(*[F.lit(_signed(m)) for m in MASKS])
    keys = values.select("fp", F.posexplode(masks).alias("t", "m")).select("fp", "t", F.expr("fp & m").alias("k"))
    full = stage(keys.groupBy("t", "k").count().where(F.col("count") > wide).select("t", "k"), "wide-buckets")
    if full.isEmpty():
        buckets = keys.select("t", "k", "fp")
    else:
        inner = F.array(*[F.array(*[F.lit(_signed(m)) for m in row]) for row in INNER_MASKS])
        again = keys.join(full, ["t", "k"], "left_semi").select("fp", "t", F.posexplode(F.get(inner, F.col("t"))).alias("j", "m"))
        again = again.select((F.col("t") * 16 + F.col("j") + 16).alias("t"), F.expr("fp & m").alias("k"), "fp")
        buckets = keys.join(full, ["t", "k"], "left_anti").select("t", "k", "fp").union(again)
    dealt = buckets.repartition("t", "k").sortWithinPartitions("t", "k", "fp")
    return dealt.mapInArrow(_links, "a long, b long")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprint and near-duplicate class of every row.

    Columns: doc_id, fingerprint (16 lowercase hex digits), component_id (smallest id of the class,
    itself included). Equal fingerprints are gathered first, so copies cost one value. Texts that are null, empty
    or blank have the fingerprint zero and link with each other and with values near zero. A null id gets its
    class like any other row, but never names one: a class without any id has a null component_id. Repeated rows are kept.
    """
    rows = stage(fingerprints(docs, id_column, text_column), "fingerprints")
    classes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-classes")
    roots = connected(near_links(classes.select("fp")))
    named = classes.join(roots, classes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of ``docs`` of each class: the one with the smallest id (null ids last; any one of repeated rows).

    Rows are numbered in a written copy, so that rows with the same id or without one are told apart.
    """
    number = "rid"
    while number in docs.columns:
        number += "_"
    numbered = stage(docs.withColumn(number, F.monotonically_increasing_id()), "numbered-documents")
    classes = near_duplicates(numbered, number, text_column).select(F.col("doc_id").alias("__rid"), F.col("component_id").alias("__class"))
    ids = numbered.select(F.col(number).alias("__rid"), F.coalesce(F.col(id_column).cast("long"), F.lit((1 << 63) - 1)).alias("__id"))
    kept = classes.join(ids, "__rid").groupBy("__class").agg(F.min(F.struct("__id", "__rid"))["__rid"].alias("__kept"))
    return numbered.join(kept, F.col(number) == F.col("__kept"), "left_semi").drop(number)
