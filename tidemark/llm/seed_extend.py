"""Repeated passages of words, by seeds that documents share and their extension both ways.

Every window of ``length`` words has a seed, its leftmost smallest stretch of ``SEED`` words by hash. Neighbouring windows mostly share
theirs, so a document has few seeds, and equal windows have equal seeds at the same place, whatever surrounds them. Each window belongs to
one seed of its document; the words of a seed's windows are its stretch.

Documents are joined on seeds. Within a group of equal seeds every stretch is compared with one leader, the occurrence of the smallest
document: equal words are followed to the left and to the right, and what agrees over the whole length of a window is a repeat, exactly as far as it
reaches. A window that does not agree holds the first differing word on one side. It goes on to the group of occurrences that differ from the leader
at the same place by the same word, with a leader of its own. So each step is linear in the group, no pairs are listed, every window is decided, and
words are compared as words: hashes only choose groups.

Groups up to ``GROUP`` occurrences are finished inside a task; a larger one takes its steps as joins of occurrences with leaders, spread over the cluster.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Runs, portions, stage
from tidemark.llm.rolling import grams, prefix_hashes

LENGTH = 50
SEED = 16
#: Occurrences of a group that a task finishes by itself. Only the division of the work depends on it.
GROUP = 1024
#: Groups with more than one in ``HOT`` of all occurrences are joined by broadcast; there are fewer than ``HOT`` of them.
HOT = 4096
#: Windows of a document that are looked at together; longer documents are cut into such pieces.
PIECE_WORDS = 1 << 18
#: Stands for a null id: after all others.
NO_ID = 2**63 - 1
NOTHING = hashlib.sha256(b"").hexdigest()

REMEMBERED_WORDS = 300_000
ROWS = "key long, ord long, rid long, pos int, lo int, hi int, before int, words string"
STEP = ROWS + ", start int, stop int"


class WordHashes(dict):
    """Hashes of words; short ones are remembered, up to a number."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= 32 and len(self) < REMEMBERED_WORDS:
            self[word] = value
        return value


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For every ``width`` neighbours the place of the first smallest one."""
    at, have = np.arange(len(values)), 1
    while have < width and len(at):
        step = min(have, width - have)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        have += step
    return at


def seeds(hashes: np.ndarray, sizes: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, ...]:
    """Seeds of texts whose words' hashes follow each other: text, hash, place, and the least and largest distance to a window's start."""
    none = np.zeros(0, dtype=np.int64)
    ends = np.cumsum(sizes)
    firsts = ends - sizes
    values = grams(prefix_hashes(hashes), seed)
    at = leftmost_least(values, length - seed + 1)
    if not len(at):
        return none, none, none, none, none
    text = np.repeat(np.arange(len(sizes)), sizes)[: len(at)]
    window = np.flatnonzero(np.arange(len(at)) + length <= ends[text])
    if not len(window):
        return none, none, none, none, none
    place = at[window]
    new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (text[window][1:] != text[window][:-1]))))
    last = np.append(new[1:], len(place)) - 1
    chosen, text = place[new], text[window[new]]
    return text, values[chosen].view(np.int64), chosen - firsts[text], chosen - window[last], chosen - window[new]


def _pieces(words: list[bytes], length: int) -> Iterator[tuple[int, list[bytes]]]:
    if len(words) <= PIECE_WORDS + length:
        yield 0, words
        return
    for start in range(0, len(words) - length + 1, PIECE_WORDS):
        yield start, words[start : start + PIECE_WORDS + length - 1]


def _scanner(length: int, seed: int):
    entry = pa.struct([("key", pa.int64()), ("pos", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("ord", pa.int64()), ("tag", pa.binary()), ("n_words", pa.int64()), ("sha256", pa.string()), ("seeds", pa.list_(entry))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in portions(texts):
                counts, sums, held = [], [], []
                owner, offset, sizes, hashes = [], [], [], []
                for i, text in enumerate(texts[lo:hi]):
                    words = text.split()
                    counts.append(len(words))
                    sums.append(hashlib.sha256(b" ".join(words)).hexdigest())
                    if len(words) >= length:
                        for start, piece in _pieces(words, length):
                            owner.append(i)
                            offset.append(start)
                            sizes.append(len(piece))
                            hashes.append(np.fromiter(map(known.__getitem__, piece), dtype=np.uint64, count=len(piece)))
                if owner:
                    text, key, pos, least, most = seeds(np.concatenate(hashes), np.array(sizes), length, seed)
                    pos = pos + np.array(offset)[text]
                    held = np.array(owner)[text]
                    columns = [pa.array(key), pa.array(pos.astype(np.int32)), pa.array(least.astype(np.int32)), pa.array(most.astype(np.int32))]
                else:
                    held, columns = np.zeros(0, dtype=np.int64), [pa.array([], f.type) for f in entry]
                ends = np.searchsorted(held, np.arange(hi - lo + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, fields=list(entry)))
                own = [batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "ord", "tag")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(counts, pa.int64()), pa.array(sums, pa.string()), lists], schema=schema)

    return scan


def _cutter(length: int):
    names = ["key", "ord", "rid", "pos", "lo", "hi", "before", "words", "n"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = batch.column("text")[i].as_py().split()
                order, rid = batch.column("ord")[i].as_py(), batch.column("rid")[i].as_py()
                wanted = batch.column("wanted")[i].values.flatten()
                key, pos, lo, hi, n = (a.to_pylist() for a in wanted)
                for at in range(0, len(key), 4096):
                    part = slice(at, at + 4096)
                    # only blanks lie outside words, so what is cut out is UTF-8 again
                    text = [b" ".join(words[p - b : p - a + length]).decode() for p, a, b in zip(pos[part], lo[part], hi[part])]
                    rows = len(text)
                    columns = [key[part], [order] * rows, [rid] * rows, pos[part], lo[part], hi[part], hi[part], text, n[part]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return cut


class Stretches:
    """Occurrences as rows of word numbers, their seeds in the same columns; -1 where a stretch holds no word."""

    def __init__(self, rows: pa.Table, length: int, seed: int, leaders: tuple[pa.Array, pa.Array] | None = None):
        self.length, self.seed, self.reach = length, seed, length - seed
        self.key, self.ord, self.rid = (rows.column(c).to_numpy() for c in ("key", "ord", "rid"))
        self.pos, self.lo, self.hi = (rows.column(c).to_numpy().astype(np.int64) for c in ("pos", "lo", "hi"))
        texts, before = rows.column("words").combine_chunks(), rows.column("before").to_numpy()
        if leaders is not None:
            texts, before = pa.concat_arrays([texts, leaders[0]]), np.concatenate((before, leaders[1].to_numpy()))
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        grid = np.full((len(texts), 2 * self.reach + seed), -1, dtype=np.int32)
        row = np.repeat(np.arange(len(texts)), sizes)
        column = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + (self.reach - before)[row]
        grid[row, column] = coded.indices.to_numpy()
        self.grid, self.lead = grid[: len(self.key)], grid[len(self.key) :]
        self.hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()), dtype=np.uint64, count=len(coded.dictionary))

    def step(self, row: np.ndarray, key: np.ndarray, lo: np.ndarray, hi: np.ndarray, lead: np.ndarray, smaller: np.ndarray):
        """Follows equal words from the seed both ways.

        ``row`` are the occurrences, ``lead`` the leader's words for each, ``smaller`` says whether the leader's document is a smaller one. Returns the
        repeats (row, start, stop) and what is undecided (row, key, lo, hi).
        """
        reach, seed = self.reach, self.seed
        mine = self.grid[row]
        same = (mine == lead) & (lead >= 0)
        centre = same[:, reach : reach + seed].all(axis=1)
        left = np.logical_and.accumulate(same[:, reach - 1 :: -1] if reach else same[:, :0], axis=1).sum(axis=1)
        right = np.logical_and.accumulate(same[:, reach + seed :], axis=1).sum(axis=1)
        far, near = np.minimum(hi, left), np.maximum(lo, reach - right)
        found = np.flatnonzero(centre & smaller & (near <= far))
        at = self.pos[row[found]]
        repeats = row[found], at - far[found], at - near[found] + self.length
        out = []
        some = np.flatnonzero(centre & (left < hi))
        word = mine[some, reach - 1 - left[some]] if len(some) else some
        out.append((some, self._key(key[some], 1, left[some], self.hashes[word]), np.maximum(lo, left + 1)[some], hi[some]))
        top = np.minimum(far, reach - right - 1)
        some = np.flatnonzero(centre & (lo <= top))
        word = mine[some, reach + seed + right[some]] if len(some) else some
        out.append((some, self._key(key[some], 2, right[some], self.hashes[word]), lo[some], top[some]))
        # seeds whose hashes agree but not their words
        some = np.flatnonzero(~centre)
        own = self.hashes[mine[some, reach : reach + seed]]
        mixed = np.zeros(len(some), dtype=np.uint64)
        for i in range(seed if len(some) else 0):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + own[:, i]
        out.append((some, self._key(key[some], 3, np.zeros(len(some), dtype=np.int64), mixed), lo[some], hi[some]))
        index, keys, lows, highs = (np.concatenate(c) for c in zip(*out))
        return repeats, (row[index], keys, lows, highs)

    @staticmethod
    def _key(key: np.ndarray, side: int, at: np.ndarray, word: np.ndarray) -> np.ndarray:
        x = key.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + at.astype(np.uint64) * np.uint64(4) + np.uint64(side)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + word
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (x ^ (x >> np.uint64(32))).view(np.int64)

    def finish(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Repeats (row, start, stop) of all groups, step by step."""
        row = np.arange(len(self.key))
        key, lo, hi = self.key, self.lo, self.hi
        out: list[tuple] = [(row[:0], row[:0], row[:0])]
        while len(row):
            order = np.lexsort((self.pos[row], self.rid[row], self.ord[row], key))
            row, key, lo, hi = row[order], key[order], lo[order], hi[order]
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            size = np.diff(np.append(first, len(key)))
            last = first + size - 1
            head = np.repeat(first, size)
            open_ = np.repeat(self.ord[row[first]] < self.ord[row[last]], size)
            leader = row[head[open_]]
            row, key, lo, hi = row[open_], key[open_], lo[open_], hi[open_]
            found, (row, key, lo, hi) = self.step(row, key, lo, hi, self.grid[leader], self.ord[row] > self.ord[leader])
            out.append(found)
        return tuple(np.concatenate(c) for c in zip(*out))


def _finisher(length: int, seed: int):
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in Runs(["key"])(batches):
            all_ = Stretches(rows, length, seed)
            row, start, stop = all_.finish()
            yield pa.RecordBatch.from_arrays([pa.array(all_.rid[row]), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))], names=["rid", "start", "stop"])

    return finish


def _stepper(length: int, seed: int):
    names = ["key", "ord", "rid", "pos", "lo", "hi", "before", "words", "start", "stop"]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                rows = pa.Table.from_batches([batch.slice(at, 4096)])
                lead = rows.column("lead_words").combine_chunks(), rows.column("lead_before").combine_chunks()
                all_ = Stretches(rows, length, seed, lead)
                row = np.arange(rows.num_rows)
                smaller = all_.ord > rows.column("lead_ord").to_numpy()
                (hit, start, stop), (more, key, lo, hi) = all_.step(row, all_.key, all_.lo, all_.hi, all_.lead, smaller)
                none = pa.nulls(len(hit), pa.int32())
                columns = [pa.nulls(len(hit), pa.int64()), pa.array(all_.ord[hit]), pa.array(all_.rid[hit]), none, none, none, none, pa.nulls(len(hit), pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))], names=names)
                left = rows.take(pa.array(more))
                kept = [left.column(c).combine_chunks() for c in ("ord", "rid", "pos")]
                ranges = [pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))]
                texts = [left.column(c).combine_chunks() for c in ("before", "words")]
                none = pa.nulls(len(more), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(key), *kept, *ranges, *texts, none, none], names=names)

    return step


def _remover():
    names = ["ord", "tag", "n_removed", "spans", "kept_sha256"]
    span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                words = batch.column("text")[i].as_py().split()
                start, stop = (a.to_numpy() for a in batch.column("marks")[i].values.flatten())
                depth = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(depth, start, 1)
                np.add.at(depth, stop, -1)
                gone = np.concatenate(([False], np.cumsum(depth) > 0))
                turns = np.flatnonzero(gone[1:] != gone[:-1])
                spans = [{"start": int(a), "stop": int(b)} for a, b in zip(turns[::2], turns[1::2])]
                kept, at = [], 0
                for s in spans:
                    kept += words[at : s["start"]]
                    at = s["stop"]
                kept += words[at:]
                out.append((len(words) - len(kept), spans, hashlib.sha256(b" ".join(kept)).hexdigest()))
            types = [pa.int64(), span, pa.string()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column("ord"), batch.column("tag"), *columns], names=names)

    return remove


def with_group(rows: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """``rows`` joined with the one row of their group. ``groups`` has a count ``n``; the few largest ones go by broadcast, their number is below ``HOT``."""
    limit = total // HOT
    large = F.broadcast(groups.where(F.col("n") > limit))
    rest = rows.join(F.broadcast(groups.where(F.col("n") > limit).select("key")), "key", "left_anti")
    joined = rows.join(large, "key")
    return joined.union(rest.join(groups.where(F.col("n") <= limit), "key").select(*joined.columns))


def _repeats(stretches: DataFrame, length: int, seed: int, group: int) -> list[DataFrame]:
    """Repeats (rid, start, stop) of all stretches; ``n`` is the size of a stretch's group."""
    columns = [c.split()[0] for c in ROWS.split(", ")]

    def small(rows: DataFrame) -> DataFrame:
        dealt = rows.select(*columns).repartition("key").sortWithinPartitions("key")
        return dealt.mapInArrow(_finisher(length, seed), "rid long, start int, stop int")

    out = [stage(small(stretches.where(F.col("n") <= group)), "repeats")]
    rows = stretches.where(F.col("n") > group).select(*columns)
    while total := rows.count():
        place = F.struct("ord", "rid", "pos")
        lead = F.min_by(F.struct("ord", "before", "words"), place).alias("lead")
        groups = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("ord").alias("last"), lead).where("lead.ord < last")
        groups = stage(groups.select("key", "n", F.col("lead.ord").alias("lead_ord"), F.col("lead.before").alias("lead_before"), F.col("lead.words").alias("lead_words")), "leaders")
        placed = with_group(rows, groups, total)
        out.append(stage(small(placed.where(F.col("n") <= group)), "repeats"))
        stepped = stage(placed.where(F.col("n") > group).mapInArrow(_stepper(length, seed), STEP), "steps")
        out.append(stepped.where("key IS NULL").select("rid", "start", "stop"))
        rows = stepped.where("key IS NOT NULL").select(*columns)
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, group: int = GROUP, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Removes every word covered by a window of ``length`` words that also starts in a document with a smaller id.

    Words are separated by space and U+0009 to U+000D. Columns: doc_id, n_words, n_removed, spans (removed runs as word numbers, the end left out), kept_sha256
    (kept words joined by one space). One row per row. Windows are judged on the input. A null text has no words. A null id counts as larger than
    all others. Rows with the same id do not remove from each other, rows that repeat id and text fare alike. A text equal to one of
    a smaller id loses all if it has a window at all. Long texts are read whole. An empty table gives an empty result. Other columns
    are not looked at, whatever their names.
    """
    seed = min(seed, length)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary").alias("text"))
    rows = rows.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("ord"), F.unhex(F.substring(F.sha2("text", 256), 1, 32)).alias("tag"), "text")
    shape = "doc_id long, ord long, tag binary, n_words long, sha256 string, seeds array<struct<key: long, pos: int, lo: int, hi: int>>"
    scanned = stage(rows.mapInArrow(_scanner(length, seed), shape).withColumn("rid", F.monotonically_increasing_id()), "seed-texts")
    # of equal texts only the first one has to be looked at
    firsts = scanned.groupBy("tag").agg(F.min(F.struct("ord", "rid")).alias("first"), F.max("n_words").alias("n_words"))
    firsts = stage(firsts.select("tag", "first.ord", "first.rid", "n_words"), "seed-firsts")
    held = scanned.join(firsts.where(F.col("n_words") >= length).select("rid"), "rid").select("ord", "rid", F.explode("seeds").alias("s"))
    occurrences = stage(held.select("s.key", "ord", "rid", "s.pos", "s.lo", "s.hi"), "seeds")
    shared = occurrences.groupBy("key").agg(F.count("*").alias("n"), F.min("ord").alias("first"), F.max("ord").alias("last")).where("first < last")
    shared = stage(shared.select("key", "n"), "shared-seeds")
    placed = with_group(occurrences, shared, occurrences.count())
    wanted = placed.groupBy("rid").agg(F.collect_list(F.struct("key", "pos", "lo", "hi", "n")).alias("wanted"))
    wanted = firsts.join(wanted, "rid").select("ord", "tag", "rid", "wanted")
    texts = rows.select("ord", "tag", "text")
    one_each = texts.join(wanted, ["ord", "tag"]).dropDuplicates(["ord", "tag"])
    stretches = stage(one_each.mapInArrow(_cutter(length), ROWS + ", n long"), "stretches")
    found = _repeats(stretches, length, seed, group)
    marks = found[0]
    for more in found[1:]:
        marks = marks.union(more)
    marks = marks.groupBy("rid").agg(F.collect_list(F.struct("start", "stop")).alias("marks"))
    marks = firsts.join(marks, "rid").select("ord", "tag", "marks")
    one_each = texts.join(marks, ["ord", "tag"]).dropDuplicates(["ord", "tag"])
    spans = "array<struct<start: int, stop: int>>"
    cut = one_each.mapInArrow(_remover(), f"ord long, tag binary, n_removed long, spans {spans}, kept_sha256 string")
    known = firsts.select("ord", "tag", F.lit(True).alias("own")).join(cut, ["ord", "tag"], "left")
    windows, own = F.col("n_words") >= length, F.col("own").isNotNull()
    everything = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("stop")))
    none = F.array().cast(spans)
    return scanned.drop("seeds", "rid").join(known, ["ord", "tag"], "left").select(
        "doc_id",
        "n_words",
        F.when(own, F.coalesce("n_removed", F.lit(0))).when(windows, F.col("n_words")).otherwise(0).cast("long").alias("n_removed"),
        F.when(own, F.coalesce("spans", none)).when(windows, everything.cast(spans)).otherwise(none).alias("spans"),
        F.when(own, F.coalesce("kept_sha256", "sha256")).when(windows, F.lit(NOTHING)).otherwise(F.col("sha256")).alias("kept_sha256"),
    )


ORACLE = r"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS MATERIALIZED (
  SELECT doc_id, place, md5(array_to_string(words[place : place + 49], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS place FROM split WHERE len(words) >= 50)),
least AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
later AS MATERIALIZED (SELECT doc_id, place FROM windows JOIN least USING (h) WHERE doc_id > first),
gone AS (
  SELECT doc_id, list(DISTINCT spot) AS places
  FROM (SELECT doc_id, unnest(range(place, place + 50)) AS spot FROM later) GROUP BY doc_id),
kept AS (
  SELECT doc_id, list(word ORDER BY spot) AS words FROM (
    SELECT s.doc_id, unnest(s.words) AS word, unnest(range(1, len(s.words) + 1)) AS spot, g.places AS places
    FROM split s JOIN gone g USING (doc_id)) WHERE NOT list_contains(places, spot) GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.words) AS BIGINT) AS n_words, CAST(coalesce(len(g.places), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN g.doc_id IS NULL THEN coalesce(array_to_string(s.words, ' '), '') ELSE coalesce(array_to_string(k.words, ' '), '') END) AS kept_sha256
FROM split s LEFT JOIN gone g USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""
