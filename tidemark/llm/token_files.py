"""Token ids as canonical length-limited Huffman code.

Global counts of ids give code lengths of at most ``LONGEST`` bits (package-merge), lengths give the canonical code. A
file holds rows of whole documents in ascending id order: one bit stream, the bit offset of every block of
``BLOCK`` ids, and the documents' ids and lengths. A block needs only its bit offset and the table to be decoded, so blocks
are decoded side by side, one table lookup per id.

Layout under a path: ``codes`` (id, bits) and ``ids`` with one folder per part in ascending order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import portions, stage
from tidemark.llm.tokens import encoder
from tidemark.sources.workspace import fresh_folder

LONGEST = 20
BLOCK = 512
#: Documents are gathered into a row of the file until it has this many ids.
ROW_IDS = 1 << 17
END_ID = 0


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``longest`` bits for positive counts, by package-merge."""
    n = len(counts)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    if n == 1:
        return np.ones(1, dtype=np.int64)
    if n > 1 << longest:
        raise ValueError("too many ids for the length limit")
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.float64)
    rows, packages = [], np.zeros(0)
    for _ in range(longest):  # from the longest length up: coins of one length, merged with packages of two from below
        merged = np.concatenate((weights, packages))
        sort = np.argsort(merged, kind="stable")
        rows.append(sort < n)
        merged = merged[sort]
        even = len(merged) // 2 * 2
        packages = merged[0:even:2] + merged[1:even:2]
    lengths, take = np.zeros(n, dtype=np.int64), 2 * n - 2
    for is_coin in reversed(rows):
        coins = int(is_coin[:take].sum())
        lengths[:coins] += 1
        take = 2 * (take - coins)
    out = np.zeros(n, dtype=np.int64)
    out[order] = lengths
    return out


def canonical(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Code of each id: shorter codes first, ties by id."""
    order = np.lexsort((ids, lengths))
    sorted_ = lengths[order]
    top = int(sorted_[-1]) if len(sorted_) else 0
    # each code takes 2^(top - length) of the 2^top leaves, in order
    leaves = np.concatenate(([0], np.cumsum(1 << (top - sorted_))[:-1])) if len(sorted_) else np.zeros(0, dtype=np.int64)
    codes = np.zeros(len(ids), dtype=np.uint64)
    codes[order] = (leaves >> (top - sorted_)).astype(np.uint64)
    return codes


class Code:
    """Tables to encode and decode, from (id, bits) pairs."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        self.ids, self.lengths = ids, lengths
        self._encode = self._decode = None

    def encode(self, values: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bit stream, and the bit offset at which each block begins."""
        if self._encode is None:
            size = int(self.ids.max()) + 1 if len(self.ids) else 0
            bits, code = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.uint64)
            bits[self.ids], code[self.ids] = self.lengths, canonical(self.ids, self.lengths)
            self._encode = bits, code
        bits, code = self._encode
        n = bits[values]
        ends = np.cumsum(n)
        starts = ends - n
        total = int(ends[-1]) if len(ends) else 0
        words = np.zeros(total // 64 + 2, dtype=np.uint64)
        if total:
            at, room = starts >> 6, 64 - n - (starts & 63)
            value = code[values]
            inside = np.where(room >= 0, value << np.maximum(room, 0).astype(np.uint64), value >> np.maximum(-room, 0).astype(np.uint64))
            first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            words[at[first]] = np.bitwise_or.reduceat(inside, first)
            over = room < 0
            words[at[over] + 1] |= value[over] << (64 + room[over]).astype(np.uint64)
        return words.astype(">u8").tobytes()[: (total + 7) // 8], starts[::BLOCK]

    def decode(self, stream: bytes, checkpoints: np.ndarray, count: int) -> np.ndarray:
        if not count:
            return np.zeros(0, dtype=np.uint32)
        if self._decode is None:
            top = int(self.lengths.max())
            order = np.lexsort((self.ids, self.lengths))
            span = 1 << (top - self.lengths[order])
            self._decode = top, np.repeat(self.ids[order].astype(np.uint32), span), np.repeat(self.lengths[order].astype(np.int64), span)
        top, symbol, length = self._decode
        if top == 1 and len(symbol) == 1:  # a single id
            return np.full(count, symbol[0], dtype=np.uint32)
        data = np.frombuffer(stream + b"\0" * 8, dtype=np.uint8)
        # the 32 bits that begin at each byte
        wide = (data[:-3].astype(np.uint32) << 24) | (data[1:-2].astype(np.uint32) << 16) | (data[2:-1].astype(np.uint32) << 8) | data[3:]
        at = checkpoints.astype(np.int64).copy()
        out = np.zeros((len(at), BLOCK), dtype=np.uint32)
        last = count - (len(at) - 1) * BLOCK
        for step in range(min(BLOCK, count)):
            if step == last:  # the last block is over
                at = at[:-1]
                if not len(at):
                    break
            window = (wide[at >> 3] << (at & 7).astype(np.uint32)) >> np.uint32(32 - top)
            out[: len(at), step] = symbol[window]
            at = at + length[window]
        return out.reshape(-1)[:count]


def _tokenizer(path: str, kind: str):
    schema = pa.schema([("part", pa.int32()), ("before", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column(1)
            for lo, hi in portions(texts):
                ids, bounds = encoder(path, kind).encode(texts.slice(lo, hi - lo), END_ID)
                raw = ids.astype("<u4").tobytes()
                sizes = np.diff(bounds)
                blobs = [raw[4 * a : 4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                if ids.size == 0 or int(ids.max()) < 1 << 16:
                    blobs = [np.frombuffer(x, dtype="<u4").astype("<u2").tobytes() for x in blobs]
                rows = [pa.array([part] * (hi - lo), pa.int32()), pa.array(before + bounds[:-1]), batch.column(0).slice(lo, hi - lo), pa.array(sizes), pa.array(blobs, pa.binary())]
                before += int(bounds[-1])
                yield pa.RecordBatch.from_arrays(rows, schema=schema)

    return tokenize


def _ids_of(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, dtype="<u2" if len(blob) == 2 * n else "<u4").astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, dtype=np.int64)
    for batch in batches:
        for n, blob in zip(batch.column("n").to_pylist(), batch.column("ids").to_pylist()):
            found = np.bincount(_ids_of(blob, n))
            if len(found) > len(total):
                total = np.concatenate((total, np.zeros(len(found) - len(total), dtype=np.int64)))
            total[: len(found)] += found
    seen = np.flatnonzero(total)
    if len(seen):
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "count"])


FILE_SCHEMA = "part int, before long, n long, bits binary, checkpoints array<long>, doc_ids array<long>, lengths array<long>"


def _packer(code: Code):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(held):
            stream, checkpoints = code.encode(np.concatenate([x[3] for x in held]))
            n = sum(len(x[3]) for x in held)
            values = [[held[0][0]], [held[0][1]], [n], [stream], [checkpoints.tolist()], [[x[2] for x in held]], [[len(x[3]) for x in held]]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=["part", "before", "n", "bits", "checkpoints", "doc_ids", "lengths"])

        held, size, follows = [], 0, None
        for batch in batches:
            for part, before, doc, n, blob in zip(*(batch.column(c).to_pylist() for c in ("part", "before", "doc_id", "n", "ids"))):
                if held and (size + n > ROW_IDS or follows != (part, before)):
                    yield row(held)
                    held, size = [], 0
                held.append((part, before, doc, _ids_of(blob, n)))
                size, follows = size + n, (part, before + n)
        if held:
            yield row(held)

    return pack


def write(docs: DataFrame, path: str, tokenizer: str, kind: str = "byte", id_column: str = "doc_id", text_column: str = "text") -> None:
    """Tokenize whole texts (null: empty), follow each by id 0, and write them in ascending order of id (null ids first, ties by text).

    Documents are dealt out by ranges of their id, once. The driver gets one count per id of the vocabulary.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ids = stage(rows.mapInArrow(_tokenizer(tokenizer, kind), "part int, before long, doc_id long, n long, ids binary"), "token-ids")
    counts = ids.select("n", "ids").mapInArrow(_count, "id long, count long").groupBy("id").agg(F.sum("count").alias("count")).toPandas()
    counts = counts.sort_values("id")
    symbols = counts["id"].to_numpy(dtype=np.int64)
    code = Code(symbols, code_lengths(counts["count"].to_numpy(dtype=np.int64)))
    spark = docs.sparkSession
    table = spark.createDataFrame(list(zip(symbols.tolist(), code.lengths.tolist())), "id long, bits int")
    table.coalesce(1).write.parquet(f"{path}/codes")
    packed = ids.mapInArrow(_packer(code), FILE_SCHEMA).sortWithinPartitions("part", "before")
    packed.write.partitionBy("part").parquet(f"{path}/ids")


def _unpacker(code: Code, keep_ids: bool):
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before, n, stream, checkpoints, docs, lengths in zip(*(batch.column(c).to_pylist() for c in ("part", "before", "n", "bits", "checkpoints", "doc_ids", "lengths"))):
                ids = code.decode(stream, np.array(checkpoints, dtype=np.int64), n).astype("<u4")
                ends = np.cumsum(lengths)
                starts = ends - lengths
                sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
                columns = {"part": pa.array([part] * len(docs), pa.int32()), "doc_id": pa.array(docs, pa.int64()), "local": pa.array(before + starts), "n_tokens": pa.array(lengths, pa.int64()), "ids_crc32": pa.array(sums, pa.int64())}
                if keep_ids:
                    columns["ids"] = pa.array([ids[a:b].tolist() for a, b in zip(starts, ends)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    return unpack


def read(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """Decode the files under ``path``: doc_id, start, n_tokens, ids_crc32, and ``ids`` where asked for.

    ``start`` adds to a document's place in its part the sizes of the parts before; there is one number per part.
    """
    rows = spark.read.schema("id long, bits int").parquet(f"{path}/codes").orderBy("id").toPandas()
    code = Code(rows["id"].to_numpy(dtype=np.int64), rows["bits"].to_numpy(dtype=np.int64))
    files = spark.read.schema(FILE_SCHEMA).parquet(f"{path}/ids")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    columns = "part int, doc_id long, local long, n_tokens long, ids_crc32 long" + (", ids array<long>" if keep_ids else "")
    decoded = files.mapInArrow(_unpacker(code, keep_ids), columns)
    joined = decoded.join(parts, "part")
    return joined.select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if keep_ids else []))


def round_trip(docs: DataFrame, tokenizer: str, kind: str = "byte", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Write the files to the shared folder and return what is read back from them."""
    spark = docs.sparkSession
    path = fresh_folder(spark, "token-files")
    write(docs, path, tokenizer, kind, id_column, text_column)
    return read(spark, path)
