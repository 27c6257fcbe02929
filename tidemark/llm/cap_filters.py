"""Near-duplicate vectors by spherical-cap filters from a structured random product code.

A vector is rotated at random and cut into two blocks; each block has a random code of ``codewords`` unit
directions, and every pair of code words is a filter direction ``u``. The inner product with a filter is the
mean of two block products, so the best filter is found block by block and all filters beyond a threshold
by walking two sorted lists (list decoding), never by trying all of them.

Each vector ``x`` is stored once, under its best filter, with inner product ``s(x)``. If cos(x, y) >= c, then
``<y, u> >= c s - sqrt(1 - c^2) sqrt(1 - s^2)`` for the filter ``u`` of ``x``, whatever the vectors are. So ``y``
list-decodes to all filters beyond that bound at its own ``s(y)`` and meets every partner whose ``s`` is not smaller; the
other ones meet ``y`` in its own filter. Every pair is met exactly once and none is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Runs, run_bounds, stage
from tidemark.llm.components import connected

THRESHOLD = 0.98
#: Stored vectors of one filter are dealt to groups of about this many; only the work's division depends on it.
GROUP = 512
#: Guards the bound against rounding.
MARGIN = 1e-9


@lru_cache(maxsize=8)
def product_code(dim: int, codewords: int, seed: int = 7) -> tuple[np.ndarray, list[np.ndarray]]:
    """A rotation and the unit code words of the blocks (one block where ``dim`` is 1)."""
    rng = np.random.default_rng([seed, dim, codewords])
    rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    cuts = [dim // 2, dim - dim // 2] if dim > 1 else [1]
    code = []
    for width in cuts:
        words = rng.normal(size=(codewords, width))
        code.append(words / np.linalg.norm(words, axis=1, keepdims=True))
    return rotation, code


def bound(s: np.ndarray, threshold: float) -> np.ndarray:
    """Least product with a filter that a partner of a vector with product ``s`` can have."""
    s = np.clip(s, -1.0, 1.0)
    return threshold * s - np.sqrt(1 - threshold**2) * np.sqrt(1 - s * s) - MARGIN


def _block_products(vectors: np.ndarray, codewords: int) -> list[np.ndarray]:
    rotation, code = product_code(vectors.shape[1], codewords)
    turned = vectors @ rotation
    scale = 1 / np.sqrt(len(code))
    out, at = [], 0
    for words in code:
        out.append(turned[:, at : at + words.shape[1]] @ words.T * scale)
        at += words.shape[1]
    return out


def best_filter(vectors: np.ndarray, codewords: int) -> tuple[np.ndarray, np.ndarray]:
    """For unit vectors: number of the best filter, and the product with it."""
    blocks = _block_products(vectors, codewords)
    number, product = np.zeros(len(vectors), dtype=np.int64), np.zeros(len(vectors))
    for block in blocks:
        best = block.argmax(axis=1)
        number = number * codewords + best
        product += block[np.arange(len(block)), best]
    return number, product


def list_decode(vectors: np.ndarray, codewords: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All (row, filter, product) with product >= ``least[row]``."""
    blocks = _block_products(vectors, codewords)
    if len(blocks) == 1:
        row, word = np.nonzero(blocks[0] >= least[:, None])
        return row, word.astype(np.int64), blocks[0][row, word]
    rows, filters, products = [], [], []
    for i in range(len(vectors)):
        first, second = blocks[0][i], blocks[1][i]
        order = np.argsort(-second)
        falling = -second[order]
        reach = np.searchsorted(falling, first - least[i], side="right")  # words of block 2 that go with each of block 1
        total = int(reach.sum())
        if not total:
            continue
        a = np.repeat(np.arange(codewords), reach)
        b = order[np.arange(total) - np.repeat(np.cumsum(reach) - reach, reach)]
        rows.append(np.full(total, i))
        filters.append(a * codewords + b)
        products.append(first[a] + second[b])
    if not rows:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    return np.concatenate(rows), np.concatenate(filters), np.concatenate(products)


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of equal length as unit vectors in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims):
        rows = np.flatnonzero(dims == dim)
        for at in range(0, len(rows), 256):
            part = batch.take(pa.array(rows[at : at + 256]))
            yield int(dim), _matrix(part.column("vec"), int(dim)), part


def _storer(codewords: int):
    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, vectors, part in _by_dim(batch):
                number, product = best_filter(vectors, codewords)
                columns = [part.column("label"), part.column("dim"), pa.array(number), pa.array(product), part.column("cid")]
                yield pa.RecordBatch.from_arrays(columns, names=["label", "dim", "filter", "s", "cid"])

    return store


def _prober(codewords: int, threshold: float):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, vectors, part in _by_dim(batch):
                _, own = best_filter(vectors, codewords)
                row, number, _ = list_decode(vectors, codewords, bound(own, threshold))
                take = pa.array(row)
                columns = [part.column("label").take(take), part.column("dim").take(take), pa.array(number), part.column("cid").take(take), pa.array(own[row])]
                yield pa.RecordBatch.from_arrays(columns, names=["label", "dim", "filter", "cid", "s"])

    return probe


def _verifier(threshold: float):
    schema = pa.schema([("cid", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in Runs(["label", "dim", "filter", "part"])(batches):
            keys = [rows.column(c).to_numpy() for c in ("label", "dim", "filter", "part")]
            probe, cid, s, copies = (rows.column(c).to_numpy() for c in ("probe", "cid", "s", "copies"))
            edges = run_bounds(*keys)
            for lo, hi in zip(edges[:-1], edges[1:]):
                middle = lo + int(np.searchsorted(probe[lo:hi], 1))
                if middle == lo or middle == hi:
                    continue
                dim = int(keys[1][lo])
                stored = _matrix(rows.column("vec").slice(lo, middle - lo), dim)
                got: dict[int, int] = {}
                root = {int(c): int(c) for c in cid[lo:middle]}

                def top(x: int) -> int:
                    while root[x] != x:
                        root[x] = x = root[root[x]]
                    return x

                for at in range(middle, hi, 1024):
                    end = min(at + 1024, hi)
                    linked = _matrix(rows.column("vec").slice(at, end - at), dim) @ stored.T >= threshold
                    # a pair belongs to the group of its member with the larger product, ties to the smaller id
                    mine, theirs = s[at:end, None], s[None, lo:middle]
                    linked &= (theirs > mine) | ((theirs == mine) & (cid[None, lo:middle] < cid[at:end, None]))
                    to_stored, to_probe = linked.T @ copies[at:end], linked @ copies[lo:middle]
                    for i in np.flatnonzero(to_stored):
                        got[int(cid[lo + i])] = got.get(int(cid[lo + i]), 0) + int(to_stored[i])
                    for i in np.flatnonzero(to_probe):
                        me = int(cid[at + i])
                        got[me] = got.get(me, 0) + int(to_probe[i])
                        root.setdefault(me, me)
                        for j in {top(int(cid[lo + j])) for j in np.flatnonzero(linked[i])}:
                            a, b = top(me), top(j)
                            root[max(a, b)] = min(a, b)
                if got:
                    ids = list(got)
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([got[i] for i in ids], pa.int64()), pa.array([top(i) for i in ids], pa.int64())], schema=schema)

    return verify


def code_size(vectors: int) -> int:
    """Code words per block: about as many filters as a quarter of the vectors, from 2^10 to 2^22."""
    return int(2 ** np.clip(np.ceil(np.log2(max(vectors, 1) / 4) / 2), 5, 11))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", group: int = GROUP) -> DataFrame:
    """Links and components of all vectors of one label with cosine >= ``threshold``.

    Columns: vec_id, n_links (other rows linked directly), component_id (smallest id reachable, itself included),
    kept. One row per input row. Vectors that are null, empty, zero, or hold a null, NaN or infinite component, and rows
    without a label, link with nothing. Vectors of different lengths never link. Equal vectors of a label are gathered first and
    counted as one with its number of copies. A null id counts as a link of others but names no component; its own component_id
    is the smallest id it reaches, or null, and kept is then false. Repeated rows count as other rows.
    """
    source = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vec"), F.col(label_column).cast("long").alias("label"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & (F.size("vec") > 0) & finite & F.exists("vec", lambda x: x != 0), F.lit(False))
    # an array of nulls in unusable rows keeps the grouping key small
    rows = source.withColumn("usable", usable)
    good = rows.where("usable").select("vec_id", "vec", "label")
    grouped = good.groupBy("label", "vec").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    classes = stage(grouped.select(F.monotonically_increasing_id().alias("cid"), "label", F.size("vec").alias("dim"), "vec", "first", "copies"), "vector-classes")
    codewords = code_size(classes.count())
    keys = ["label", "dim", "filter"]
    slim = classes.select("cid", "label", "dim", "vec")
    stored = stage(slim.mapInArrow(_storer(codewords), "label long, dim int, filter long, s double, cid long"), "stored-vectors")
    occupied = stored.groupBy(*keys).agg(F.ceil(F.count("*") / group).cast("int").alias("parts"), F.max("s").alias("most"))
    probes = slim.mapInArrow(_prober(codewords, threshold), "label long, dim int, filter long, cid long, s double")
    probes = probes.join(occupied, keys).where("most >= s")
    probes = probes.select(*keys, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("probe"), "cid", "s")
    placed = stored.join(occupied, keys).select(*keys, F.pmod(F.xxhash64("cid"), "parts").cast("int").alias("part"), F.lit(0).alias("probe"), "cid", "s")
    meeting = placed.union(probes).join(classes.select("cid", "vec", "copies"), "cid")
    dealt = meeting.repartition(*keys, "part").sortWithinPartitions(*keys, "part", "probe", "cid")
    found = stage(dealt.mapInArrow(_verifier(threshold), "cid long, links long, root long"), "vector-links")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = connected(found.select("cid", "root"))
    named = classes.join(counts, "cid", "left").join(roots, F.col("cid") == F.col("node"), "left").select("cid", "label", "vec", "first", F.coalesce("root", "cid").alias("root"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(least, "root").select("label", "vec", "n_links", "component_id")
    linked = good.join(named, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
