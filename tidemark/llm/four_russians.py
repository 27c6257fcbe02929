"""Hard negatives of embeddings by exact integer scores, looked up in the manner of the Four Russians.

Components become integers and are kept as bit planes: eight neighbouring dimensions of one plane are a byte. For an anchor, a
table of 256 subset sums per group of eight dimensions answers what any such byte contributes, so that a score is a sum of
lookups, shifted by plane, the sign plane taken off. Nothing is approximated and no candidate is left out.

Rows are dealt to chunks of about ``CHUNK``, anchors to blocks of about ``BLOCK``; every chunk meets every block in one group
of bounded size, first for the positives, then, with their scores known, for the negatives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage

GROUP = 8
#: Rows of a chunk and anchors of a block; only the division of the work depends on them.
CHUNK = 8192
BLOCK = 1024
#: Integers are held in 64 bits; larger components are set to the ends of this range, and sums wrap as longs do.
LEAST, MOST = -(2**63), 2**63 - 1
#: Stands for a null id in comparisons: after all others.
NO_ID = MOST


def whole(vectors: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) as 64-bit integers."""
    low = np.floor(scale * vectors)
    out = np.clip(low, -(2.0**62), 2.0**62).astype(np.int64)
    out[low >= 2.0**62] = MOST
    out[low < -(2.0**62)] = LEAST
    return out


def bit_planes(numbers: np.ndarray) -> np.ndarray:
    """Bytes (plane, group, row) of the two's complement of ``numbers`` (row, dimension); the last plane is the sign."""
    rows, dim = numbers.shape
    groups = -(-dim // GROUP)
    padded = np.zeros((rows, groups * GROUP), dtype=np.int64)
    padded[:, :dim] = numbers
    widest = int(np.maximum(padded, ~padded).max(initial=0))
    out = np.empty((widest.bit_length() + 1, groups, rows), dtype=np.uint8)
    for plane in range(len(out)):
        bits = (padded >> np.int64(min(plane, 63)) & 1).astype(np.uint8)
        out[plane] = np.packbits(bits.reshape(rows, groups, GROUP), axis=2, bitorder="little")[:, :, 0].T
    return out


def subset_sums(anchor: np.ndarray) -> np.ndarray:
    """For each group of eight dimensions the sums of all 256 subsets of the anchor's components."""
    groups = -(-len(anchor) // GROUP)
    padded = np.zeros(groups * GROUP, dtype=np.int64)
    padded[: len(anchor)] = anchor
    out = np.zeros((groups, 1 << GROUP), dtype=np.int64)
    for bit, part in enumerate(padded.reshape(groups, GROUP).T):
        out[:, 1 << bit : 2 << bit] = out[:, : 1 << bit] + part[:, None]
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products of one anchor with all rows of ``planes``: lookups added by group, shifted by plane."""
    total = np.zeros(planes.shape[2], dtype=np.int64)
    for plane in range(len(planes) - 1, -1, -1):
        looked = np.zeros_like(total)
        for group in range(len(tables)):
            looked += tables[group].take(planes[plane, group])
        total = -looked if plane == len(planes) - 1 else (total << 1) + looked
    return total


def _packer(scale: float):
    names = ["rid", "vec_id", "label", "dim", "planes", "packed"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                for at in range(0, len(rows), 1024):
                    part = batch.take(pa.array(rows[at : at + 1024]))
                    flat = part.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, int(dim))
                    planes = bit_planes(whole(flat, scale))
                    packed = np.ascontiguousarray(planes.transpose(2, 0, 1)).reshape(part.num_rows, -1)
                    columns = [part.column(c) for c in names[:4]]
                    columns += [pa.array(np.full(part.num_rows, len(planes)), pa.int32()), pa.array([row.tobytes() for row in packed], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return pack


def _unpack(rows: pa.Table, dim: int) -> np.ndarray:
    """Planes of all rows, the narrower ones carried on by their sign."""
    groups = -(-dim // GROUP)
    count = rows.column("planes").to_numpy()
    out = np.zeros((int(count.max(initial=1)), groups, rows.num_rows), dtype=np.uint8)
    packed = rows.column("packed").to_pylist()
    for planes in np.unique(count):
        at = np.flatnonzero(count == planes)
        own = np.frombuffer(b"".join(packed[i] for i in at), dtype=np.uint8).reshape(len(at), int(planes), groups).transpose(1, 2, 0)
        out[:planes, :, at] = own
        out[planes:, :, at] = own[-1]
    return out


def _numbers(planes: np.ndarray, dim: int) -> np.ndarray:
    """Rows of integers again."""
    total = np.zeros((planes.shape[2], planes.shape[1] * GROUP), dtype=np.int64)
    for plane in range(len(planes) - 1, -1, -1):
        bits = np.unpackbits(planes[plane].T, axis=1, bitorder="little").astype(np.int64)
        total = -bits if plane == len(planes) - 1 else (total << 1) + bits
    return total[:, :dim]


def _first(score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` first rows by falling score, then by id."""
    if len(score) > 4 * most:
        cut = np.partition(score, len(score) - most)[len(score) - most]
        near = np.flatnonzero(score >= cut)
    else:
        near = np.arange(len(score))
    return near[np.lexsort((ids[near], ~score[near]))[:most]]


class Chunk:
    """The candidates of one group as arrays, ordered by label."""

    def __init__(self, rows: pa.Table, dim: int):
        order = np.argsort(rows.column("label").to_numpy(), kind="stable")
        rows = rows.take(pa.array(order))
        self.label, self.rid = rows.column("label").to_numpy(), rows.column("rid").to_numpy()
        self.ids = rows.column("vec_id").fill_null(NO_ID).to_numpy()
        self.planes = _unpack(rows, dim)

    def of_label(self, label: int) -> slice:
        return slice(int(np.searchsorted(self.label, label, side="left")), int(np.searchsorted(self.label, label, side="right")))


def _ids(values: list[int]) -> pa.Array:
    return pa.array([None if v == NO_ID else v for v in values], pa.int64())


def _positives(most: int):
    def find(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if candidates.num_rows and anchors.num_rows:
            dim = candidates.column("dim")[0].as_py()
            chunk, numbers = Chunk(candidates, dim), _numbers(_unpack(anchors, dim), dim)
            for i, (rid, label) in enumerate(zip(anchors.column("rid").to_pylist(), anchors.column("label").to_pylist())):
                same = chunk.of_label(label)
                others = np.flatnonzero(chunk.rid[same] != rid) + same.start
                score = scores(subset_sums(numbers[i]), chunk.planes[:, :, others])
                for j in _first(score, chunk.ids[others], most):
                    out.append((rid, int(chunk.ids[others[j]]), int(score[j])))
        rid, ids, score = zip(*out) if out else ((), (), ())
        return pa.table({"rid": pa.array(rid, pa.int64()), "positive_id": _ids(ids), "positive_score": pa.array(score, pa.int64())})

    return find


def _negatives(most: int, least_share: int, most_share: int):
    def find(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if candidates.num_rows and anchors.num_rows:
            dim = candidates.column("dim")[0].as_py()
            chunk, numbers = Chunk(candidates, dim), _numbers(_unpack(anchors, dim), dim)
            rids, labels, wanted = (anchors.column(c).to_pylist() for c in ("rid", "label", "wanted"))
            for i, rid in enumerate(rids):
                same = chunk.of_label(labels[i])
                score = scores(subset_sums(numbers[i]), chunk.planes)
                other = np.ones(len(score), dtype=bool)
                other[same] = False
                for positive in sorted(set(wanted[i])):
                    # 100 * score >= share * positive, without leaving 64 bits
                    low, high = -(-least_share * positive // 100), most_share * positive // 100
                    if low > high or low > MOST or high < LEAST:
                        continue
                    fits = np.flatnonzero(other & (score >= max(low, LEAST)) & (score <= min(high, MOST)))
                    for j in fits[_first(score[fits], chunk.ids[fits], most)]:
                        out.append((rid, positive, int(chunk.ids[j]), int(score[j])))
        rid, positive, ids, score = zip(*out) if out else ((), (), (), ())
        return pa.table({"rid": pa.array(rid, pa.int64()), "positive_score": pa.array(positive, pa.int64()), "negative_id": _ids(ids), "negative_score": pa.array(score, pa.int64())})

    return find


def _meet(rows: DataFrame, anchors: DataFrame, chunks: int, blocks: int, find, schema: str) -> DataFrame:
    """Every chunk of rows with every block of anchors of the same number of dimensions."""
    part = F.pmod(F.xxhash64("rid"), F.lit(chunks)).cast("int").alias("chunk")
    block = F.pmod(F.xxhash64("rid", F.lit(1)), F.lit(blocks)).cast("int").alias("block")
    left = rows.select("*", part, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    # names of their own: both sides come from one table
    right = anchors.select(*[F.col(c).alias(c) for c in anchors.columns], block, F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    keys = ["dim", "chunk", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(find, schema)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    n_positives: int = 5,
    n_negatives: int = 10,
    scale: float = 256.0,
    least_share: int = 30,
    most_share: int = 90,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    chunk: int = CHUNK,
    block: int = BLOCK,
) -> DataFrame:
    """The first negatives for every anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` and ``label`` are conditions over the columns ``vec_id`` and ``label``; without ``label`` the given one counts.
    Scores are inner products of floor(scale * x). A positive is one of the first ``n_positives`` other rows with the anchor's label by
    falling score, ties by smaller id; a negative has another label and a score of ``least_share`` to ``most_share`` percent of the
    positive's. A positive with a score below 0 therefore has none.

    Rows without a label, without a vector, or with a null, NaN or infinite component take no part. Rows with a null id are candidates
    (after all ids at equal score) but never anchors. Repeated rows are rows of their own: each is an anchor, and a positive of the
    other. Only vectors of the same length are compared; empty ones score 0 with each other. An empty table gives an empty result.
    Other columns are not looked at, whatever their names.
    """
    spark = vectors.sparkSession
    own = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).cast("long").alias("label"), F.col(vector_column).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = own.where(F.col("label").isNotNull() & F.col("vec").isNotNull() & finite)
    own = own.select("vec_id", (F.col("label") if label is None else label).cast("long").alias("label"), "vec").where("label IS NOT NULL")
    numbered = own.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", F.size("vec").alias("dim"), "vec")
    rows = stage(numbered.mapInArrow(_packer(scale), "rid long, vec_id long, label long, dim int, planes int, packed binary"), "planes")
    anchors = rows.where(F.coalesce(is_anchor & F.col("vec_id").isNotNull(), F.lit(False)))
    n_rows, n_anchors = rows.count(), anchors.count()
    chunks, blocks = max(1, -(-n_rows // chunk)), max(1, -(-n_anchors // block))

    def best(found: DataFrame, keys: list[str], score: str, ids: str, most: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(ids).asc_nulls_last())
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)

    positives = _meet(rows, anchors, chunks, blocks, _positives(n_positives), "rid long, positive_id long, positive_score long")
    positives = stage(best(positives, ["rid"], "positive_score", "positive_id", n_positives).drop("rank"), "positives")
    wanted = positives.groupBy("rid").agg(F.collect_set("positive_score").alias("wanted"))
    asking = anchors.join(wanted, "rid")
    negatives = _meet(rows, asking, chunks, blocks, _negatives(n_negatives, least_share, most_share), "rid long, positive_score long, negative_id long, negative_score long")
    negatives = best(negatives, ["rid", "positive_score"], "negative_score", "negative_id", n_negatives)
    named = positives.join(anchors.select("rid", F.col("vec_id").alias("anchor_id")), "rid")
    return named.join(negatives, ["rid", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = """
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(CAST(x AS DOUBLE))]) = 0),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM given a JOIN given c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id
WHERE NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 10
"""
