"""Repeated passages across documents by a hash-compared suffix sort.

Every window (a string of ``length`` bytes) has an anchor value: the least hash of the grams inside it. Equal windows have equal values, and
neighbouring windows mostly share one, so a run of windows with one value is shipped as one stretch of text. Values that occur in
two documents go on (a bit table of fixed size holds them; false hits only cost work). Stretches of one value meet, their suffixes are sorted,
and neighbours in the order with a common extension of ``length`` bytes or more are the same window.

The sort is a bottom-up mergesort whose comparisons are logarithmic: prefix polynomial hashes tell whether two suffixes share
their first m bytes, a binary search finds the common extension, the next byte decides. It begins with suffixes dealt by their
first eight bytes, read as one number, so only those that share them are merged. Neighbours are then
verified byte by byte; where a hash collided, the group is sorted again by its bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import Runs, hand_back, portions, run_bounds, stage
from tidemark.llm.rolling import grams, mix, prefix_hashes, sliding_min, span
from tidemark.session import shuffles_dropped

LENGTH = 50
GRAM = 24
#: A stretch of windows with one value is cut after this many (repetitive text).
LONGEST_RUN = 256
#: Bytes of one document hashed at once; pieces overlap by LENGTH - 1.
PIECE = 1 << 20
#: Bits of the table of shared values; it bounds what is broadcast, whatever the corpus.
TABLE_BITS = 26
#: Documents (ids and tags, or digests) that are sent to all executors; more of them are joined by shuffle instead, texts included.
BROADCAST_ROWS = 1 << 20
#: Stretches of one value are sorted in groups of about this many, then the groups' leaders once more.
GROUP = 4096
#: Groups are sorted side by side up to about this many windows.
WINDOWS = 1 << 16
NO_ID = (1 << 63) - 1


def _bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def stretches(raw: np.ndarray, owner: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Anchor value, content hash, first window and number of windows of all stretches of one buffer.

    ``owner`` numbers the document of each byte; windows over a border are left out.
    """
    empty = np.zeros(0, dtype=np.int64)
    if len(raw) < length:
        return empty.view(np.uint64), empty.view(np.uint64), empty, empty
    prefix = prefix_hashes(raw)
    gram = min(GRAM, length)
    value = sliding_min(grams(prefix, gram), length - gram + 1)
    whole = owner[: len(value)] == owner[length - 1 : length - 1 + len(value)]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1 : len(value)] != owner[: len(value) - 1]) | ~whole[:-1]
    at = np.flatnonzero(new)
    since = np.arange(len(value)) - np.repeat(at, np.diff(np.append(at, len(value))))
    first = np.flatnonzero((since % LONGEST_RUN == 0) & whole)
    bounds = np.flatnonzero((since % LONGEST_RUN == 0) | ~whole)
    after = np.append(bounds, len(value))[np.searchsorted(bounds, first) + 1]
    n = after - first
    return value[first], mix(span(prefix, first, after + length - 1) + n.astype(np.uint64)), first, n


def _pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Buffers of about PIECE bytes: bytes, row of each byte, place in its document of each row's first byte here."""
    held, rows, starts = [], [], {}
    size = 0

    def flush():
        lengths = [len(b) for b in held]
        return np.frombuffer(b"".join(held), dtype=np.uint8), np.repeat(np.array(rows, dtype=np.int64), lengths), np.array([starts[r] for r in range(len(starts))], dtype=np.int64)

    for i, text in enumerate(texts):
        raw = _bytes(text)
        starts[i] = 0
        if len(raw) < LENGTH:
            continue
        for at in range(0, len(raw) - LENGTH + 1, PIECE):
            part = raw[at : at + PIECE + LENGTH - 1]
            if held and (size + len(part) > PIECE or at):
                yield flush()
                held, rows, size = [], [], 0
            held.append(part)
            rows.append(i)
            starts[i] = at
            size += len(part)
    if held:
        yield flush()


def _numbered(texts: list[str | None], lo: int, hi: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``_pieces`` of some of the texts, with rows numbered among all."""
    for raw, owner, starts in _pieces(texts[lo:hi]):
        yield raw, owner + lo, np.concatenate((np.zeros(lo, dtype=np.int64), starts))


def _stretch_rows(batch: pa.RecordBatch):
    for start in range(0, batch.num_rows, 1024):
        texts = batch.column("text").slice(start, 1024).to_pylist()
        for raw, owner, starts in (buffer for lo, hi in portions(texts) for buffer in _numbered(texts, lo, hi)):
            value, content, first, n = stretches(raw, owner)
            if not len(first):
                continue
            row = owner[first]
            begin = np.searchsorted(owner, row)  # rows stand in order in one buffer
            yield value, content, first - begin + starts[row], n, row + start


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hand_back()
    for batch in batches:
        doc = batch.column("doc").to_numpy()
        for value, _, _, _, row in _stretch_rows(batch):
            # once per value and document of this buffer
            pair = np.unique(np.stack([value.view(np.int64), doc[row]]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], names=["h", "doc"])


def _in_table(value: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = value & np.uint64((1 << TABLE_BITS) - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _shared(table):
    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand_back()
        bits = table.value
        for batch in batches:
            doc, tag = batch.column("doc"), batch.column("tag")
            for value, content, at, n, row in _stretch_rows(batch):
                hit = _in_table(value, bits)
                take = pa.array(row[hit])
                columns = [pa.array(value[hit].view(np.int64)), pa.array(content[hit].view(np.int64)), doc.take(take), tag.take(take), pa.array(at[hit]), pa.array(n[hit])]
                yield pa.RecordBatch.from_arrays(columns, names=["h", "c", "doc", "tag", "at", "n"])

    return shared


# ---- the sort ------------------------------------------------------------------------------------------------


class Suffixes:
    """Suffixes of some byte strings, compared over at most ``length`` bytes. Several groups, each sorted on its own, lie side by
    side: ``bounds`` are their starts and the end."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray, bounds: np.ndarray | None = None, length: int = LENGTH):
        self.raw, self.starts, self.length = raw, starts, length
        self.bounds = np.array([0, len(starts)]) if bounds is None else bounds
        self.prefix = prefix_hashes(raw)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common extension of the suffixes numbered a and b by binary search over hashes; all windows are whole."""
        low, high = np.zeros(len(a), dtype=np.int64), np.full(len(a), self.length)
        x, y = self.starts[a], self.starts[b]
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = span(self.prefix, x, x + middle) == span(self.prefix, y, y + middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def above(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Where suffix a comes strictly after suffix b."""
        common = self.extension(a, b)
        at = np.minimum(common, self.length - 1)
        return (common < self.length) & (self.raw[self.starts[a] + at] > self.raw[self.starts[b] + at])

    def _rank(self, values: np.ndarray, order: np.ndarray, lo: np.ndarray, hi: np.ndarray, upper: bool) -> np.ndarray:
        """For each of ``values`` how many of order[lo:hi] stand before it (equal ones too where ``upper``)."""
        first, lo, hi = lo, lo.copy(), hi.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo - first
            middle = (lo[open_] + hi[open_]) // 2
            mine, other = values[open_], order[middle]
            before = ~self.above(other, mine) if upper else self.above(mine, other)
            lo[open_[before]], hi[open_[~before]] = middle[before] + 1, middle[~before]

    def _dealt(self) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of their first eight bytes, group by group, and the bounds of those that share them."""
        if self.length < 8 or not len(self.starts):
            return np.arange(len(self.starts)), self.bounds
        # big-endian numbers compare as their bytes do
        head = np.ndarray(len(self.raw) - 7, dtype=">u8", buffer=np.ascontiguousarray(self.raw), strides=(1,))[self.starts].astype(np.uint64)
        group = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        order = np.lexsort((head, group))
        head = head[order]
        new = head[1:] != head[:-1]
        edges = self.bounds[(self.bounds > 0) & (self.bounds < len(order))]
        new[edges - 1] = True
        return order, np.concatenate(([0], np.flatnonzero(new) + 1, [len(order)]))

    def order(self) -> np.ndarray:
        """Bottom-up mergesort of suffixes that share their first bytes: in each round every pair of neighbouring sorted runs is merged
        by ranking into each other."""
        order, bounds = self._dealt()
        sizes, width = np.diff(bounds), 1
        begin, end = np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)
        place = np.flatnonzero(end - begin > 1)
        while len(place):
            first, last = begin[place], end[place]
            run = (place - first) // width
            left = run % 2 == 0
            lo = np.minimum(first + np.where(left, run + 1, run - 1) * width, last)
            hi = np.minimum(lo + width, last)
            ahead = np.empty(len(place), dtype=np.int64)
            values = order[place]
            ahead[left] = self._rank(values[left], order, lo[left], hi[left], False)
            ahead[~left] = self._rank(values[~left], order, lo[~left], hi[~left], True)
            order[np.where(left, place, place - width) + ahead] = values
            width *= 2
            place = place[last - first > width]
        return order

    def classes(self) -> np.ndarray:
        """A number per suffix, equal exactly for equal windows of one group. Verified on bytes."""
        order = self.order()
        x, y = self.starts[order[:-1]], self.starts[order[1:]]
        same = span(self.prefix, x, x + self.length) == span(self.prefix, y, y + self.length)
        border = np.zeros(len(same) + 1, dtype=bool)
        border[self.bounds[1:-1]] = True
        if not self._verified(order, same, border[1:]):
            group = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
            strings = [b"%d:" % g + self.raw[s : s + self.length].tobytes() for g, s in zip(group, self.starts)]
            return np.unique(np.array(strings, dtype=object), return_inverse=True)[1]
        number = np.zeros(len(order), dtype=np.int64)
        number[order[1:]] = np.cumsum(~same | border[1:])
        return number

    def _verified(self, order: np.ndarray, same: np.ndarray, border: np.ndarray) -> bool:
        """Neighbours called the same are so, and the others rise strictly but over the border of two groups."""
        step = np.arange(self.length)
        for at in range(0, len(same), 1 << 14):
            part = slice(at, min(at + (1 << 14), len(same)))
            a = self.raw[self.starts[order[:-1][part]][:, None] + step]
            b = self.raw[self.starts[order[1:][part]][:, None] + step]
            differs = a != b
            if (differs.any(axis=1) == same[part]).any():
                return False
            first = differs.argmax(axis=1)
            line = np.arange(len(first))
            if ((a[line, first] > b[line, first]) & ~same[part] & ~border[part]).any():
                return False
        return True


def _sorted_windows(rows: pa.Table, lo: int, hi: int, edges: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of stretches lo..hi: class, owner row and first byte of each window, in the stretches' order, and the buffer."""
    texts = rows.column("bytes").slice(lo, hi - lo).to_pylist()
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    n = rows.column("n").slice(lo, hi - lo).to_numpy()
    owner = np.repeat(np.arange(hi - lo), n)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    starts = (np.cumsum(sizes) - sizes)[owner] + within
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    bounds = np.append(0, np.cumsum(n))[edges - lo]
    return Suffixes(raw, starts, bounds).classes(), owner, within, raw, starts


FOUND = pa.schema([("doc", pa.int64()), ("tag", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("h", pa.int64()), ("bytes", pa.binary())])


def _sort(leaders: bool):
    """Marks (doc, tag, at, n) of windows that a smaller document of the group has; ``bytes`` is null in them.

    With ``leaders``, groups that are one of several of their value (``parts`` > 1) also hand on the windows of their smallest
    documents, with their bytes and keyed by their content, to be sorted once more among all groups.
    """

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in Runs(["h", "part"])(batches):
            h, part = rows.column("h").to_numpy(), rows.column("part").to_numpy()
            docs, tags, ats, parts = (rows.column(c).to_numpy() for c in ("doc", "tag", "at", "parts"))
            edges = run_bounds(h, part)
            upto = np.append(0, np.cumsum(rows.column("n").to_numpy()))[edges]
            at = 0
            while at < len(edges) - 1:
                # whole groups of about WINDOWS windows at a time
                to = max(int(np.searchsorted(upto, upto[at] + WINDOWS, side="right")) - 1, at + 1)
                lo, hi, mine_edges = int(edges[at]), int(edges[to]), edges[at : to + 1]
                at = to
                number, owner, within, raw, starts = _sorted_windows(rows, lo, hi, mine_edges)
                doc = docs[lo:hi][owner]
                least = np.full(int(number.max()) + 1, NO_ID)
                np.minimum.at(least, number, doc)
                later = least[number] < doc
                # neighbouring windows of a stretch in one row
                new = later.copy()
                new[1:] &= ~(later[:-1] & (owner[1:] == owner[:-1]))
                first = np.flatnonzero(new)
                count = np.add.reduceat(later.astype(np.int64), first) if len(first) else first
                source = owner[first] + lo
                columns = [docs[source], tags[source], ats[source] + within[first], count, np.zeros(len(first), dtype=np.int64)]
                if len(first):
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.nulls(len(first), pa.binary())], schema=FOUND)
                mine = np.flatnonzero(~later & (parts[lo:hi][owner] > 1)) if leaders else []
                if len(mine):
                    prefix = prefix_hashes(raw)
                    for i in range(0, len(mine), 1 << 14):
                        some = mine[i : i + (1 << 14)]
                        begin = starts[some]
                        key = mix(span(prefix, begin, begin + LENGTH)).view(np.int64)
                        source = owner[some] + lo
                        text = pa.array([raw[b : b + LENGTH].tobytes() for b in begin], pa.binary())
                        ones = np.ones(len(some), dtype=np.int64)
                        columns = [docs[source], tags[source], ats[source] + within[some], ones, key]
                        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), text], schema=FOUND)

    return sort


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted stretches of each text."""
    schema = pa.schema([("h", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("parts", pa.int64()), ("bytes", pa.binary())])
    for batch in batches:
        for i in range(batch.num_rows):
            raw = _bytes(batch.column("text")[i].as_py())
            doc, tag = batch.column("doc")[i].as_py(), batch.column("tag")[i].as_py()
            wanted = batch.column("wanted")[i].values
            h, at, n, parts = (wanted.field(k).to_numpy() for k in range(4))
            for lo in range(0, len(h), 1 << 13):
                some = slice(lo, lo + (1 << 13))
                text = [raw[a : a + m + LENGTH - 1] for a, m in zip(at[some].tolist(), n[some].tolist())]
                k = len(text)
                columns = [h[some], np.full(k, doc), np.full(k, tag), at[some], n[some], parts[some]]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(text, pa.binary())], schema=schema)


def spans(n_bytes: int, at: np.ndarray, n: np.ndarray, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by windows at..at+n."""
    if not len(at):
        return []
    order = np.argsort(at, kind="stable")
    lo, hi = at[order], np.maximum.accumulate(at[order] + n[order] + length - 1)
    new = np.flatnonzero(np.append(True, lo[1:] > hi[:-1]))
    ends = hi[np.append(new[1:] - 1, len(hi) - 1)]
    return list(zip(lo[new].tolist(), np.minimum(ends, n_bytes).tolist()))


def _remover(keep_text: bool):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                raw = _bytes(batch.column("text")[i].as_py())
                if batch.column("copy")[i].as_py():
                    gone = [(0, len(raw))] if len(raw) >= LENGTH else []
                else:
                    marks = batch.column("marks")[i]
                    gone = spans(len(raw), *(marks.values.field(k).to_numpy() for k in range(2))) if marks.is_valid else []
                rest, at = [], 0
                for lo, hi in gone:
                    rest.append(raw[at:lo])
                    at = hi
                rest = b"".join([*rest, raw[at:]])
                found = [len(raw), sum(hi - lo for lo, hi in gone), len(gone), hashlib.sha256(rest).hexdigest()]
                # a cut inside a character leaves bytes that are no UTF-8: they are dropped from the text, not from the digest
                out.append([*found, rest.decode("utf-8", "ignore") if keep_text else None])
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types]
            names = ["doc_id", "carried", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("carried"), *columns], names=names)

    return remove


def _with_entry(texts: DataFrame, entries: DataFrame) -> DataFrame:
    """Texts that have a row in ``entries``, picked before they are shuffled where the ids are few enough to send to all."""
    if entries.count() > BROADCAST_ROWS:
        return texts
    return texts.join(F.broadcast(entries.select("doc", "tag")), ["doc", "tag"], "left_semi")


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep_text: bool = False, carry: Column | None = None) -> DataFrame:
    """Removes every byte covered by a 50-byte string that also starts in a document with a smaller id.

    Columns: doc_id, carried (``carry`` handed through, or null), n_bytes, n_removed, n_spans, kept_sha256, kept_text (where asked for; bytes of
    characters that a cut went through are left out). One row per row. A null text is empty. A null id counts as larger than all others.
    Rows with the same id do not remove from each other. Texts equal to one of a smaller id lose all (if they have a window at all).
    """
    spark = docs.sparkSession
    carried = (F.lit(None).cast("int") if carry is None else carry).alias("carried")
    rows = docs.select(carried, F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    digest = F.sha2(F.col("text").cast("binary"), 256)
    rows = rows.withColumn("doc", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("digest", F.unhex(F.substring(digest, 1, 32)))
    # texts that occur twice: all but the one of the smallest id go whole
    again = rows.groupBy("digest").agg(F.min("doc").alias("least"), F.count("*").alias("n")).where("n > 1")
    again = stage(again.select("digest", "least"), "suffix-texts")
    tag = F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("long")
    small = again.count() <= BROADCAST_ROWS
    known = rows.join(F.broadcast(again) if small else again, "digest", "left").withColumn("tag", tag).withColumn("copy", F.coalesce(F.col("doc") > F.col("least"), F.lit(False)))
    known = known.select("carried", "doc_id", "doc", "tag", "copy", "text")
    if not small:
        known = stage(known, "suffix-documents")
    # rows that repeat id and text are the same document here
    texts = known.where(~F.col("copy") & (F.octet_length("text") >= LENGTH)).select("doc", "tag", "text")
    values = texts.mapInArrow(_values, "h long, doc long").groupBy("h").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi")
    word = F.shiftright(F.col("h").bitwiseAND(F.lit((1 << TABLE_BITS) - 1)), 6).alias("word")
    bit = F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit")
    # at most 2^(TABLE_BITS - 6) rows
    with shuffles_dropped(spark):
        words = values.select(word, bit).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(1 << (TABLE_BITS - 6), dtype=np.uint64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    table = spark.sparkContext.broadcast(bits)
    shared = stage(texts.mapInArrow(_shared(table), "h long, c long, doc long, tag long, at long, n long"), "suffix-stretches")
    leaders = stage(shared.groupBy("h", "c").agg(F.min("doc").alias("least")), "suffix-leaders")
    several = leaders.groupBy("h").agg(F.count("*").alias("k"), F.min("least").alias("lo"), F.max("least").alias("hi")).where("lo < hi")
    placed = stage(shared.join(leaders, ["h", "c"]).select("h", "doc", "tag", "at", "n", "least"), "suffix-placed")
    whole = placed.where("doc > least").select("doc", "tag", "at", "n")
    open_ = placed.where("doc = least").join(several.select("h", F.ceil(F.col("k") / GROUP).cast("long").alias("parts")), "h")
    wanted = open_.groupBy("doc", "tag").agg(F.collect_set(F.struct("h", "at", "n", "parts")).alias("wanted"))
    wanted = stage(wanted, "suffix-wanted")
    one_each = _with_entry(texts, wanted).join(wanted, ["doc", "tag"]).dropDuplicates(["doc", "tag"])
    pieces = one_each.mapInArrow(_extract, "h long, doc long, tag long, at long, n long, parts long, bytes binary")
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("doc"), F.col("parts")))
    columns = "doc long, tag long, at long, n long, h long, bytes binary"
    dealt = pieces.repartition("h", "part").sortWithinPartitions("h", "part")
    found = stage(dealt.mapInArrow(_sort(True), columns), "suffix-found")
    again = found.where("bytes IS NOT NULL").withColumn("part", F.lit(0).cast("long")).withColumn("parts", F.lit(1).cast("long"))
    second = again.repartition("h").sortWithinPartitions("h", "part").mapInArrow(_sort(False), columns)
    marks = found.where("bytes IS NULL").union(second).select("doc", "tag", "at", "n").union(whole)
    marks = marks.groupBy("doc", "tag").agg(F.collect_set(F.struct("at", "n")).alias("marks"))
    marks = stage(marks, "suffix-marks")
    columns = ["doc_id", "carried", "copy", "text", "marks"]
    # copies go whole and need no marks
    unmarked = F.lit(None).cast(marks.schema["marks"].dataType).alias("marks")
    originals = known.where(~F.col("copy"))
    if marks.count() <= BROADCAST_ROWS:
        ids = F.broadcast(marks.select("doc", "tag"))
        alone = originals.join(ids, ["doc", "tag"], "left_anti").withColumn("marks", unmarked).select(columns)
        originals = originals.join(ids, ["doc", "tag"], "left_semi").join(marks, ["doc", "tag"]).select(columns).union(alone)
    else:
        originals = originals.join(marks, ["doc", "tag"], "left").select(columns)
    copies = known.where("copy").withColumn("marks", unmarked).select(columns)
    numbers = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"
    out = StructType([known.schema["doc_id"], known.schema["carried"], *StructType.fromDDL(numbers).fields])
    return originals.union(copies).mapInArrow(_remover(keep_text), out)
