"""Packing token pieces into sequences by patterns fitted with non-negative least squares.

Only the histogram of piece lengths (one count per length up to the limit) goes to the driver. Patterns of few
documents that fill a sequence on a coarse grid are enumerated, their repeat counts are fitted to the histogram by
non-negative least squares and rounded down. Each pattern is then made of exact lengths: its larger members
are taken from their grid cells, the last one and whatever still fits are the best fitting lengths left. What the rounding
leaves over is packed largest first. Everything is done on counts, so the plan's size follows the number of
lengths and not of documents. Documents find their place by their rank among pieces of equal length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import portions, stage
from tidemark.llm.tokens import encoder

LIMIT = 4096
END_ID = 1
CELLS = 64
MEMBERS = 4
#: Pieces of one length are ranked in this many groups by a hash of their document.
SLOTS = 1024


def patterns(cells: int = CELLS, members: int = MEMBERS) -> list[tuple[int, ...]]:
    """Falling sequences of at most ``members`` whole numbers that add up to ``cells``."""

    def parts(left: int, most: int, room: int):
        if left == 0:
            yield ()
        elif room and most * room >= left:
            for first in range(min(left, most), 0, -1):
                for rest in parts(left - first, first, room - 1):
                    yield (first, *rest)

    return list(parts(cells, cells, members))


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 500) -> np.ndarray:
    """Least squares with x >= 0 by an active set that grows with the steepest column."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[free] = 0
        best = int(slope.argmax())
        if slope[best] <= 1e-9 * max(1.0, float(np.abs(b).max())):
            break
        free[best] = True
        while True:
            at = np.flatnonzero(free)
            solved = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (solved > 0).all():
                x[:] = 0
                x[at] = solved
                break
            down = solved <= 0
            step = np.min(x[at][down] / np.maximum(x[at][down] - solved[down], 1e-300))
            x[at] += step * (solved - x[at])
            drop = at[(x[at] <= 1e-12) & down]
            if not len(drop):
                drop = at[down]
            free[drop], x[drop] = False, 0.0
            if not free.any():
                break
    return x


def plan(counts: dict[int, int], limit: int = LIMIT) -> list[tuple[int, list[tuple[int, int]]]]:
    """Sequences as (repeats, [(length, how often)...]); together they hold exactly the counted pieces."""
    left = {int(k): int(v) for k, v in counts.items() if v > 0}
    lengths = sorted(left)
    out: list[tuple[int, list[tuple[int, int]]]] = []

    def largest(most: int) -> int:
        i = bisect_right(lengths, most)
        return lengths[i - 1] if i else 0

    def use(members: dict[int, int], times: int) -> None:
        out.append((times, sorted(members.items(), reverse=True)))
        for length, n in members.items():
            left[length] -= n * times
            if not left[length]:
                lengths.pop(bisect_right(lengths, length) - 1)

    def fill(members: dict[int, int], room: int) -> None:
        """Adds the largest lengths that still fit, one after the other."""
        most = room
        while room > 0 and (length := largest(min(most, room))):
            n = min(room // length, left[length] - members.get(length, 0))
            if n > 0:
                members[length] = members.get(length, 0) + n
                room -= n * length
            most = length - 1

    def times(members: dict[int, int]) -> int:
        return min(left[length] // n for length, n in members.items())

    cell = -(-limit // CELLS)
    full = left.get(limit, 0)
    if full:
        use({limit: 1}, full)
    shapes = [p for p in patterns() if len(p) > 1]
    histogram = np.zeros(CELLS)
    for length, n in left.items():
        if n:
            histogram[-(-length // cell) - 1] += n
    a = np.zeros((CELLS, len(shapes)))
    for j, shape in enumerate(shapes):
        for c in shape:
            a[c - 1, j] += 1
    fitted = np.floor(nnls(a, histogram) + 1e-9).astype(np.int64) if histogram.any() else np.zeros(len(shapes), dtype=np.int64)
    # shapes of large members first: they have the fewest ways to be filled
    for j in sorted(np.flatnonzero(fitted), key=lambda j: shapes[j], reverse=True):
        repeats = int(fitted[j])
        while repeats:
            members: dict[int, int] = {}
            room = limit
            for c in shapes[j][:-1]:
                length = largest(min(c * cell, room))
                if length <= (c - 1) * cell:
                    break
                # lengths this sequence has already used up are passed over
                while length > (c - 1) * cell and members.get(length, 0) >= left[length]:
                    length = largest(length - 1)
                if length <= (c - 1) * cell:
                    break
                members[length] = members.get(length, 0) + 1
                room -= length
            else:
                fill(members, room)
                n = min(repeats, times(members))
                use(members, n)
                repeats -= n
                continue
            break
    while lengths:
        members = {}
        fill(members, limit)
        use(members, times(members))
    return out


def _places(counts: dict[int, int], limit: int) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first rank, first sequence, members per sequence and first offset of every stretch of ranks."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for times, members in plan(counts, limit):
        offset = 0
        for length, n in members:
            rank = used.get(length, 0)
            found.setdefault(length, []).append((rank, sequence, n, offset))
            used[length] = rank + n * times
            offset += n * length
        sequence += times
    return {length: tuple(np.array(x, dtype=np.int64) for x in zip(*rows)) for length, rows in found.items()}


def _placer(places: dict[int, tuple[np.ndarray, ...]]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), dtype=np.int64), np.zeros(len(rank), dtype=np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                size = int(length[rows[0]])
                first, base, n, start = places[size]
                i = np.searchsorted(first, rank[rows], side="right") - 1
                within = rank[rows] - first[i]
                sequence[rows] = base[i] + within // n[i]
                offset[rows] = start[i] + within % n[i] * size
            columns = [batch.column(c) for c in batch.schema.names if c != "rank"]
            names = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return place


def _cutter(path: str, kind: str, limit: int, keep_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for lo, hi in portions(texts):
                ids, bounds = encoder(path, kind).encode(texts.slice(lo, hi - lo), END_ID)
                raw = ids.astype("<u4")
                sizes = np.diff(bounds)
                n = -(-sizes // limit)
                row = np.repeat(np.arange(hi - lo), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * limit
                length = np.minimum(limit, sizes[row] - start)
                begin = bounds[row] + start
                sums = [zlib.crc32(raw[a:b]) for a, b in zip(begin.tolist(), (begin + length).tolist())]
                columns = [batch.column(0).slice(lo, hi - lo).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(sums, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array([raw[a : a + m].tolist() for a, m in zip(begin.tolist(), length.tolist())], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return cut


def pack(docs: DataFrame, tokenizer: str, kind: str = "word", limit: int = LIMIT, id_column: str = "doc_id", text_column: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ``ids`` where asked for).

    A document is its ids and the end id (a null or empty text: the end id alone). Only longer ones than ``limit`` are cut.
    Repeated rows are packed each on its own; null ids are kept. A length that very many pieces share is ranked in groups.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    columns = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<long>" if keep_ids else "")
    cut = rows.mapInArrow(_cutter(tokenizer, kind, limit, keep_ids), columns)
    pieces = stage(cut.withColumn("slot", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SLOTS))), "pieces")
    groups = pieces.groupBy("length", "slot").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in groups.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most one row per length
    earlier = Window.partitionBy("length").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    bases = groups.select("length", "slot", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "slot").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("within", F.row_number().over(inside)).join(bases, ["length", "slot"])
    ranked = ranked.select(*[c for c in pieces.columns if c != "slot"], (F.col("base") + F.col("within") - 1).alias("rank"))
    return ranked.mapInArrow(_placer(_places(counts, limit)), columns + ", sequence_id long, offset long")
