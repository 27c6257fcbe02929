"""Document fingerprints from closed syncmers.

A k-mer of code points is chosen when the least of its inner s-mers stands at its first or last place. The choice depends on
the k-mer alone, so an edit changes anchors only where it touches them, and every stretch of ``2 k - s - 1`` code points has one. All
chosen k-mers are kept, each distinct one with the place of its first occurrence, so a fingerprint grows with its text.
Two fingerprints are alike as far as they share anchors at places shifted by one common distance.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import portions
from tidemark.llm.rolling import grams, prefix_hashes, sliding_min

K = 16
S = 8
#: Code points looked at in one go; neighbouring pieces overlap by K - 1.
PIECE = 1 << 18
#: Matches may be this far off the common shift.
SLACK = 8
#: Text of a block of neighbouring rows, and rows drawn per block to find where blocks begin.
BLOCK_BYTES = 4 << 20
DRAWN = 32
#: Characters of texts whose fingerprints are handed on in one go.
TOGETHER = 1 << 20

Anchors = tuple[np.ndarray, np.ndarray]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def syncmers(points: np.ndarray, k: int = K, s: int = S) -> Anchors:
    """Places and hashes of all closed syncmers."""
    prefix = prefix_hashes(points)
    small = grams(prefix, s)
    least = sliding_min(small, k - s + 1)
    n = len(points) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    at = np.flatnonzero((small[:n] == least) | (small[k - s : k - s + n] == least))
    return at, grams(prefix, k)[at]


def anchors(text: str) -> Anchors:
    """Hashes (ascending, 32 bits) and first places of all distinct syncmers of a whole text.

    A text without a syncmer (shorter than ``K``) has the hash of the whole text as its only anchor; an empty one has none.
    """
    points = code_points(text)
    found, places = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    for start in range(0, max(len(points) - K + 1, 0), PIECE):
        at, hashes = syncmers(points[start : start + PIECE + K - 1])
        found.append(hashes >> np.uint64(32))
        places.append(at + start)
    hashes, first = np.unique(np.concatenate(found), return_index=True)  # the first of equal ones is the earliest
    if len(hashes):
        return hashes, np.concatenate(places)[first]
    if len(points):
        digest = hashlib.sha256(points.tobytes()).digest()
        return np.array([int.from_bytes(digest[:4], "little")], dtype=np.uint64), np.zeros(1, dtype=np.int64)
    return hashes, np.zeros(0, dtype=np.int64)


def as_string(found: Anchors) -> str:
    return ",".join(f"{h:08x}@{p:x}" for h, p in zip(found[0].tolist(), found[1].tolist()))


def likeness(a: Anchors, b: Anchors) -> float:
    """Share of the anchors of both that are in both and agree on the shift; 1 for two empty texts."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    union = len(a[0]) + len(b[0]) - len(i)
    if not union:
        return 1.0
    if not len(i):
        return 0.0
    ordered = np.sort(b[1][j] - a[1][i])
    most = int((np.searchsorted(ordered, ordered + SLACK, side="right") - np.arange(len(ordered))).max())
    return most / union


def edited(text: str, other: str) -> str:
    n = len(text) // 3
    return text[: len(text) - n] + other[:n]


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, int | None, str]]:
    for batch in batches:
        columns = [batch.column(c) for c in ("block", "lead", "doc_id", "text")]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in columns)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walks the rows of each block in order, with the row before in hand; a block ends with the first row of the next one."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    rows: list[tuple] = []
    size, before = 0, None
    for block, lead, key, other in _in_order(batches):
        if before is not None and before[0] == block:
            _, mine_key, text, mine = before
            following = anchors(other)
            new = edited(text, other)
            changed = anchors(new)
            digest = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
            rows.append((mine_key, len(text), digest, as_string(mine), as_string(changed), likeness(mine, changed), likeness(mine, following)))
            size += len(text) + len(new)
        else:
            following = None
        if lead:
            before = None
        else:
            before = (block, key, other, anchors(other) if following is None else following)
        if size > TOGETHER or len(rows) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for lo, hi in portions(texts, TOGETHER):
            found = [as_string(anchors(t or "")) for t in texts[lo:hi]]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(found, pa.string())], names=["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Columns doc_id and fingerprint ("hash@place,..."); a null or empty text has the empty fingerprint."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(_fingerprint, "doc_id long, fingerprint string")


Place = tuple[bool, int, int]


def _places(ids: Iterable[int | None], ties: Iterable[int]) -> list[Place]:
    """Sort keys: falling ids, null ones last, then rising ties."""
    return [(True, 0, int(t)) if i is None else (False, ~int(i), int(t)) for i, t in zip(ids, ties)]


def _block_starts(slim: DataFrame, blocks: int) -> list[Place]:
    """The first rows of about ``blocks`` even blocks, the very first row among them.

    Rows are drawn by hash, about ``DRAWN`` for each block, so the driver receives a number that follows the number of blocks.
    """
    first = slim.orderBy(F.col("doc_id").desc_nulls_last(), "tie").limit(1).toArrow()
    total = slim.count()
    share = min(1.0, blocks * DRAWN / max(total, 1))
    drawn = slim.where(F.pmod(F.xxhash64("doc_id", "tie"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).distinct().toArrow()
    found = sorted(_places(drawn.column("doc_id").to_pylist(), drawn.column("tie").to_pylist()))
    starts = set(found[:: max(1, -(-len(found) // blocks))])
    return sorted(starts.union(_places(first.column("doc_id").to_pylist(), first.column("tie").to_pylist())))


def edit_check(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The following row is the next one by falling id (ties in the order of their texts' hash, null ids last; after the
    last the first; a single row follows itself). Null texts count as empty; repeated rows are rows of their own; empty input gives no rows.

    Rows are dealt once, to blocks of that order of about ``block_bytes`` of text; the first row of a block goes to the block before
    as well, the very first one to the last block. A block is read in order with one row in hand, so texts are shuffled once and nothing is stored.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    spark = docs.sparkSession
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    starts = _block_starts(rows.select("doc_id", "tie"), max(4 * parts, -(-size // block_bytes)))
    # about as many as blocks
    shared = spark.sparkContext.broadcast(starts)

    @F.pandas_udf("array<bigint>")
    def blocks(ids: pd.Series, ties: pd.Series) -> pd.Series:
        own, out = shared.value, []
        for place in _places((i if isinstance(i, str) else None for i in ids), ties):
            block = bisect.bisect_right(own, place) - 1
            # ~b: the row also ends block b
            out.append([block, ~((block - 1) % len(own))] if own[block] == place else [block])
        return pd.Series(out)

    # ids as text: pandas would turn a column with nulls into floating point
    dealt = rows.withColumn("to", F.explode(blocks(F.col("doc_id").cast("string"), "tie")))
    dealt = dealt.select("doc_id", "tie", "text", (F.col("to") < 0).alias("lead"), F.when(F.col("to") < 0, F.bitwise_not("to")).otherwise(F.col("to")).alias("block"))
    order = ["block", "lead", F.col("doc_id").desc_nulls_last(), "tie"]
    dealt = dealt.repartition("block").sortWithinPartitions(*order).select("block", "lead", "doc_id", "text")
    columns = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.mapInArrow(_compare, columns)
