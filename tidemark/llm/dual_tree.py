"""Ranked lexical search by two hierarchies, one over items and one over documents.

A document is a vector of term saturations, an item one of weights times repeats; a score is their inner product and all
coordinates are non-negative integers. A node of either hierarchy holds the maximum of each coordinate over its members, so the
product of two nodes' maxima is no less than any score between them. A pair of nodes whose bound lies below the weakest k-th
score of the items in it cannot change a result and is dropped with all documents and items below; pairs are split until
single documents meet single items, where the bound is the score. Nothing is approximated.

Documents are read as text once per page of items, keeping the tally of the page's terms in each. Each task builds hierarchies
over slices of its documents. A k-th score among any part of the documents bounds the k-th among all from below: one document in
``PROBE``, by hash, is searched first, and its scores start all tasks off, so that a task reports little more than what can be in the result.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import portions
from tidemark.sources.workspace import fresh_folder

#: A term is a run of letters a-z (A-Z lower-cased), digits and bytes from 0x80 on.
SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
TRANSLATION = bytes(32 if c in SEPARATORS else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Items (and bytes of their texts) that share one pass over the documents' texts, and those that share a hierarchy. Averages of a
#: deal by hash; they bound what a task holds.
PAGE_ITEMS, PAGE_BYTES = 16_384, 4 << 20
TREE_ITEMS, TREE_BYTES = 256, 256 << 10
#: Members of the nodes on each level, from the top.
DOC_SIZES = (2048, 256, 32, 4, 1)
FAN = 4
#: Postings of a slice, beyond which it is closed before it has ``DOC_SIZES[0]`` documents.
SLICE_POSTINGS = 1 << 20
PROBE = 64
#: Stands for a null id: after all others.
NO_ID = 2**63 - 1


def terms(text: bytes) -> list[bytes]:
    return text.translate(TRANSLATION).split()


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


# ------------------------------------------------------------------- items


def _alike_order(vectors: np.ndarray) -> np.ndarray:
    """An order in which neighbours are alike: halves around two distant members, again and again."""
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = vectors / np.where(norms > 0, norms, 1)
    out, pending = [], [np.arange(len(vectors))]
    while pending:
        rows = pending.pop()
        if len(rows) <= FAN:
            out.append(rows)
            continue
        a = int(np.argmin(unit[rows] @ unit[rows].mean(axis=0)))
        to_a = unit[rows] @ unit[rows[a]]
        to_b = unit[rows] @ unit[rows[int(np.argmin(to_a))]]
        rows = rows[np.argsort(to_b - to_a, kind="stable")]
        # cut where nodes begin, so that no node spans two halves of its level
        node = FAN
        while node * FAN < len(rows):
            node *= FAN
        half = node * max(1, len(rows) // (2 * node))
        pending += [rows[half:], rows[:half]]
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


@dataclass
class ItemTree:
    """Items in order of likeness and, from the top, the coordinate maxima (term, node) of each level; the last level are the items."""

    numbers: np.ndarray
    maxima: list[np.ndarray]
    #: Place of each of the page's terms among this tree's, -1 where no item has it; and an order of terms that follows the items'.
    local: np.ndarray
    place: np.ndarray
    weight: np.ndarray

    @staticmethod
    def build(numbers: list[int], tallies: list[dict[int, int]], weight: np.ndarray) -> ItemTree:
        used = np.unique(np.fromiter((t for tally in tallies for t in tally), dtype=np.int64))
        local = np.full(len(weight), -1, dtype=np.int64)
        local[used] = np.arange(len(used))
        dense = np.zeros((len(tallies), len(used)), dtype=np.int64)
        for row, tally in zip(dense, tallies):
            at = local[np.fromiter(tally, dtype=np.int64, count=len(tally))]
            row[at] = np.fromiter(tally.values(), dtype=np.int64, count=len(tally)) * weight[used[at]]
        order = _alike_order(dense.astype(np.float64))
        dense = dense[order]
        first = np.where((dense > 0).any(axis=0), (dense > 0).argmax(axis=0), len(dense)) if len(dense) else np.zeros(0, dtype=np.int64)
        levels = [np.ascontiguousarray(dense.T)]
        while levels[0].shape[1] > 1:
            below = levels[0]
            levels.insert(0, np.maximum.reduceat(below, np.arange(0, below.shape[1], FAN), axis=1))
        place = np.empty(len(used), dtype=np.int64)
        place[np.argsort(first, kind="stable")] = np.arange(len(used))
        return ItemTree(np.asarray(numbers, dtype=np.int64)[order], levels, local, place, weight[used])


# --------------------------------------------------------------- documents


class DocTree:
    """A slice of documents: per level the terms and maxima of each node, as rows of one array."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, value: np.ndarray, tree: ItemTree):
        """``doc`` rises; one entry per document and term."""
        n_terms = len(tree.weight)
        starts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        weighed = value * tree.weight[term]
        most = np.maximum.reduceat(weighed, starts)
        own = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(doc))))
        heaviest = np.minimum.reduceat(np.where(weighed == most[own], tree.place[term], n_terms), starts)
        order = np.argsort(heaviest, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        self.docs = doc[starts][order]
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        key = rank[own] * n_terms + term
        by = np.argsort(key)
        key, value = key[by], value[by]
        size = 1
        for wanted in reversed(DOC_SIZES):
            if wanted > size:
                key = (key // n_terms // (wanted // size)) * n_terms + key % n_terms
                by = np.argsort(key, kind="stable")
                key, value = key[by], value[by]
                first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
                key, value = key[first], np.maximum.reduceat(value, first)
                size = wanted
            nodes = -(-len(order) // wanted)
            bounds = np.searchsorted(key, np.arange(nodes + 1) * n_terms)
            self.levels.insert(0, (bounds, key % n_terms, value))


class Search:
    """The best documents of every item of a tree so far."""

    def __init__(self, tree: ItemTree, most: int, start: np.ndarray):
        self.tree, self.most = tree, most
        self.best: list[list[tuple[int, int]]] = [[] for _ in tree.numbers]
        self.least = np.maximum(start, 1)
        self._settle()
        #: Scores worked out, for tests and reports.
        self.scored = 0

    def _settle(self) -> None:
        """The weakest k-th score of every node; scores found later only raise it."""
        self.floors = [self.least]
        for _ in self.tree.maxima[1:]:
            below = self.floors[0]
            self.floors.insert(0, np.minimum.reduceat(below, np.arange(0, len(below), FAN)))

    def add(self, docs: DocTree, ids: np.ndarray) -> None:
        self.docs, self.ids = docs, ids
        if len(self.tree.numbers) and len(docs.docs):
            self._visit(0, 0, np.zeros(1, dtype=np.int64))

    def _alive(self, level: int, nodes: np.ndarray, at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        maxima = self.tree.maxima[level]
        part = maxima[at] if len(nodes) == maxima.shape[1] else maxima[at[:, None], nodes]
        bound = values @ part
        alive = bound >= self.floors[level][nodes]
        return nodes[alive], bound[alive]

    def _below(self, level: int, nodes: np.ndarray) -> np.ndarray:
        out = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
        return out[out < self.tree.maxima[level + 1].shape[1]]

    def _visit(self, depth: int, node: int, nodes: np.ndarray) -> None:
        bounds, at, values = self.docs.levels[depth]
        at, values = at[bounds[node] : bounds[node + 1]], values[bounds[node] : bounds[node + 1]]
        last = len(self.tree.maxima) - 1
        level = min(depth, last)
        nodes, score = self._alive(level, nodes, at, values)
        if not len(nodes):
            return
        if depth + 1 < len(DOC_SIZES):
            if depth == 1:
                self._settle()
            if level < last:
                nodes = self._below(level, nodes)
            step = DOC_SIZES[depth] // DOC_SIZES[depth + 1]
            for child in range(node * step, min((node + 1) * step, len(self.docs.levels[depth + 1][0]) - 1)):
                self._visit(depth + 1, child, nodes)
            return
        while level < last and len(nodes):
            nodes, score = self._alive(level + 1, self._below(level, nodes), at, values)
            level += 1
        self.scored += len(nodes)
        me = int(self.ids[self.docs.docs[node]])
        for item, found in zip(nodes.tolist(), score.tolist()):
            best = self.best[item]
            if len(best) < self.most:
                heapq.heappush(best, (found, -me))
            else:
                heapq.heappushpop(best, (found, -me))
            if len(best) == self.most and best[0][0] > self.least[item]:
                self.least[item] = best[0][0]


# -------------------------------------------------------------------- jobs


def _tallier(vocabulary):
    names = ["doc_id", "n", "terms", "counts"]

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            for lo, hi in portions(texts):
                sizes, ends, found, counts = [], [0], [], []
                for text in texts[lo:hi]:
                    words = terms(text) if text else []
                    own = Counter(map(known.get, words))
                    own.pop(None, None)
                    sizes.append(len(words))
                    found += own.keys()
                    counts += own.values()
                    ends.append(len(found))
                ends = pa.array(ends, pa.int32())
                columns = [ids.slice(lo, hi - lo), pa.array(sizes, pa.int64())]
                columns += [pa.ListArray.from_arrays(ends, pa.array(values, pa.int32())) for values in (found, counts)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return tally


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ends = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False).cumsum()
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, before + SLICE_POSTINGS, side="right"))
        stop = min(max(stop, start + 1), start + DOC_SIZES[0], batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def _searcher(shared, most: int, documents: int, length: int):
    names = ["item", "doc_id", "score"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, start = shared.value
        found = Search(tree, most, start)
        for batch in batches:
            for part in _slices(batch):
                held = part.column("terms")
                doc = np.repeat(np.arange(part.num_rows), held.value_lengths().to_numpy(zero_copy_only=False))
                term = tree.local[held.flatten().to_numpy()]
                count = part.column("counts").flatten().to_numpy().astype(np.int64)
                mine = term >= 0
                doc, term, count = doc[mine], term[mine], count[mine]
                if not len(doc):
                    continue
                size = part.column("n").to_numpy()
                middle = 100 - 25 + (25 * size * documents) // length
                value = (1_000_000_000 * count) // (1000 * count + 12 * middle[doc])
                ids = part.column("doc_id").fill_null(NO_ID).to_numpy()
                found.add(DocTree(doc, term, value, tree), ids)
        rows = [(int(item), -me, score) for item, best in zip(tree.numbers, found.best) for score, me in best]
        item, ids, score = zip(*rows) if rows else ((), (), ())
        ids = pa.array([None if i == NO_ID else i for i in ids], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), ids, pa.array(score, pa.int64())], names=names)

    return search


def _ranked(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Tallies of the page's terms, stored apart for the documents that are searched first."""
    spark = docs.sparkSession
    rows = docs.mapInArrow(_tallier(spark.sparkContext.broadcast(vocabulary)), "doc_id long, n long, terms array<int>, counts array<int>")
    rows = rows.withColumn("probe", (F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(PROBE)) == 0).cast("int"))
    path = fresh_folder(spark, "term-tallies")
    rows.write.partitionBy("probe").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def rank(
    docs: DataFrame,
    items: DataFrame,
    most: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    page: tuple[int, int] = (PAGE_ITEMS, PAGE_BYTES),
    tree: tuple[int, int] = (TREE_ITEMS, TREE_BYTES),
) -> DataFrame:
    """The ``most`` documents with the highest scores above 0 for each row of ``items``: item_id, rank, doc_id, score.

    Equal scores rank by smaller id, null ids last. Texts without a term, null ones among them, neither score nor count as
    documents; an item without a term has no rows. Repeated rows are documents, or items, of their own. Very long texts are read whole; a
    text's tally holds the terms of the items only. Empty tables give an empty result. Other columns are not looked at, whatever their names.

    What the driver and each task hold is one page of items: about ``page`` (items, bytes of text) for the terms, about
    ``tree`` for the hierarchies. More items mean more pages, each with a pass over the texts, and more hierarchies, each with a pass over the tallies.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").cast("binary").alias("text"))
    asked = items.select(F.col(item_column).cast("long").alias("item_id"), F.col(item_text_column).cast("string").cast("binary").alias("text"))
    count, size = asked.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    pages = max(1, -(-count // page[0]), -(-size // page[1]))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for number in range(pages):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(pages)) == number).toArrow()
        ids, tallies = rows.column("item_id").to_pylist(), [Counter(terms(t or b"")) for t in rows.column("text").to_pylist()]
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*tallies)))}
        if not vocabulary:
            continue
        postings = _postings(texts, vocabulary)
        documents, length = postings.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not documents:
            return out
        # as many rows as the page has terms, at most
        holding = postings.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
        weight = np.zeros(len(vocabulary), dtype=np.int64)
        weight[holding.column("term").to_numpy()] = [term_weight(documents, n) for n in holding.column("count").to_pylist()]
        numbered = [{vocabulary[t]: n for t, n in tally.items()} for tally in tallies]
        trees = max(1, -(-len(ids) // tree[0]), -(-sum(len(t or b"") for t in rows.column("text").to_pylist()) // tree[1]))
        names = spark.createDataFrame(pa.table({"item": pa.array(range(len(ids)), pa.int32()), "item_id": pa.array(ids, pa.int64())}))
        for own in range(trees):
            members = list(range(own, len(ids), trees))
            hierarchy = ItemTree.build(members, [numbered[i] for i in members], weight)
            start = np.zeros(len(members), dtype=np.int64)
            for narrowed in (True, False):
                shared = spark.sparkContext.broadcast((hierarchy, start))
                part = postings.where("probe = 1") if narrowed else postings
                found = _ranked(part.mapInArrow(_searcher(shared, most, documents, length), "item int, doc_id long, score long"), most)
                if narrowed:
                    # one row per item of the hierarchy, at most
                    known = dict(found.where(F.col("rank") == most).select("item", "score").collect())
                    start = np.array([known.get(int(i), 0) for i in hierarchy.numbers], dtype=np.int64)
            out = out.union(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out


ORACLE = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
asked AS (
  SELECT item_id, term, count(*) AS repeats FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term),
held AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
sizes AS MATERIALIZED (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM held GROUP BY doc_id),
total AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS length FROM sizes),
weights AS MATERIALIZED (
  SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, total WHERE term IN (SELECT term FROM asked) GROUP BY term, documents),
scored AS (
  SELECT item_id, doc_id,
    CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * documents) // length)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN sizes USING (doc_id), total GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""
