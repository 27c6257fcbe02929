"""Toxicity of texts after undoing disguise by a noisy-channel decoder.

A written token is seen as a clean word sent through a channel that swaps letters for look-alikes, repeats letters, puts
separators between them or spaces them out. A token, or a run of neighbouring short tokens with the blanks between them, becomes a
lattice of what each character may stand for, a blank for itself or for nothing; Viterbi finds the path that is
likeliest under the channel and a character trigram model counted over all texts learned from. Words counted in those texts stand as they are. The restored words
are scored by their log odds in toxic and other texts, and a logistic regression turns the score's parts into a probability.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import PIECE_BYTES, largest_classes, stage

#: Look-alikes and the letters they stand for.
LOOKALIKES = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "g",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "|": "il",
    "+": "t",
    "(": "c",
    "<": "c",
}
SEPARATORS = ".,-_*~'\"`:;/\\#%&=^?)>[]{}"
#: Log costs of the channel.
SWAP, DROP, SHRINK, JOIN = -1.0, -0.7, -0.3, -1.0
#: A token that is a word gives way to its decoded form if it is less than this as frequent.
DISGUISED = 0.01
#: The most frequent words are what every task holds of the words counted; a rarer token is decoded.
FREQUENT_WORDS = 1 << 16
#: Bounds of what the classifier is fitted on and keeps.
SAMPLE_ROWS = 20_000
WORDS = 20_000
LEAST_TOXIC = 3
REMEMBERED = 200_000

BLANK = re.compile(r"\S+")
DOUBLE = re.compile(r"(.)\1")
RUN = re.compile(r"(.)\1*")
#: Neighbouring tokens of up to three characters.
SHORT = re.compile(r"(?<!\S)\S{1,3}(?:[^\S\n]+\S{1,3})+(?!\S)")
PLAIN = re.compile(r"[a-z]+")
EDGE = "".join(sorted(set(SEPARATORS + "%&*#$!@|+(<")))
LETTERS = 27


def letter(c: str) -> int:
    return ord(c) - 96


def _pieces(text: str) -> Iterator[str]:
    """A very long text in stretches cut at a blank."""
    at = 0
    while len(text) - at > PIECE_BYTES:
        cut = at + PIECE_BYTES
        while cut < len(text) and not text[cut].isspace():
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total = np.zeros(LETTERS**3, dtype=np.int64)
        for value in batch.column(0):
            for piece in _pieces(value.as_py() or ""):
                raw = np.frombuffer(piece.encode("utf-8", "surrogatepass"), dtype=np.uint8) | 32
                code = np.where((raw >= 97) & (raw <= 122), raw - 96, 0).astype(np.int64)
                code = np.concatenate(([0, 0], code, [0]))
                code = code[2:] + code[1:-1] * LETTERS + code[:-2] * LETTERS**2
                total += np.bincount(code, minlength=LETTERS**3)
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], names=["cell", "n"])


def letter_model(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """log p(letter | two before), 0 standing for everything that is no letter; counted over all texts given."""
    texts = docs.select(F.col(text_column).cast("string").alias("text"))
    cells = texts.mapInArrow(_trigrams, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # at most 27^3 rows
    counts = np.zeros(LETTERS**3)
    for r in cells:
        counts[r["cell"]] = r["n"]
    counts = counts.reshape(LETTERS, LETTERS, LETTERS)
    single = (counts.sum(axis=(0, 1)) + 1) / (counts.sum() + LETTERS)
    double = counts.sum(axis=0)
    double = (double + 5 * single) / (double.sum(axis=1, keepdims=True) + 5)
    return np.log((counts + 5 * double[None]) / (counts.sum(axis=2, keepdims=True) + 5))


def _raw_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total: Counter[str] = Counter()
        for value in batch.column(0):
            for piece in _pieces(value.as_py() or ""):
                total.update(piece.lower().split())
        words: Counter[str] = Counter()
        for token, n in total.items():
            core = token.strip(EDGE)
            if 1 < len(core) <= 32 and core.isalpha():
                words[core] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["word", "n"])


def word_counts(docs: DataFrame, text_column: str = "text", words: int = FREQUENT_WORDS) -> dict[str, int]:
    """The most frequent words of two letters or more, as written, with their counts over all texts given: at most ``words``, equally frequent ones all or none."""
    texts = docs.select(F.col(text_column).cast("string").alias("text"))
    counted = stage(texts.mapInArrow(_raw_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1"), "toxic-words")
    return {r["word"]: r["n"] for r in largest_classes(counted, "n", words).collect()}


def decode(token: str, model: list[list[list[float]]]) -> str:
    """The likeliest clean words behind lower-case tokens of letters, look-alikes and separators, with one blank between two of them."""
    best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    i = 0
    while i < len(token):
        c = token[i]
        j = i
        while j < len(token) and token[j] == c:
            j += 1
        run = j - i
        stands = c if "a" <= c <= "z" else LOOKALIKES.get(c, "")
        cost = 0.0 if stands == c else SWAP
        options = []
        for s in stands:
            code = letter(s)
            options.append((cost + (SHRINK * (run - 1) if run > 1 else 0.0), (code,)))
            if run > 1:
                options.append((2 * cost + SHRINK * (run - 2), (code, code)))
        if c == " ":
            options += [(0.0, (" ",)), (JOIN, ())]
        elif not c.isalnum():
            options.append((DROP, ()))
        if not options:  # outside the lattice: a border to the letters around, and itself if it is a letter
            options.append((0.0, (c if c.isalpha() else " ",) * (run if c.isalpha() else 1)))
        after: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (score, path) in best.items():
            for price, codes in options:
                x, y, value, way = a, b, score + price, path
                for sign in codes:
                    code = sign if type(sign) is int else 0
                    value += model[x][y][code]
                    x, y, way = y, code, (way, sign)
                if (x, y) not in after or after[x, y][0] < value:
                    after[x, y] = (value, way)
        best = after
        i = j
    _, way = max(((score + model[a][b][0], path) for (a, b), (score, path) in best.items()), key=lambda p: p[0])
    out = []
    while way:
        way, sign = way
        out.append(chr(96 + sign) if type(sign) is int else sign)
    return "".join(reversed(out))


def undouble(token: str, model: list[list[list[float]]]) -> str:
    """``decode`` for tokens of letters a-z only: each run of a letter stands for one or two of it, so two states suffice at any place."""
    # (letter before, last letter, score, path) with the last run read as one letter, and as two
    states = [(0, 0, 0.0, ())]
    for run in RUN.finditer(token):
        size = run.end() - run.start()
        code, last = ord(token[run.start()]) - 96, states[0][1]
        one = max(((score + (SHRINK * (size - 1) + model[a][b][code]), way) for a, b, score, way in states), key=_score)
        after = [(last, code, one[0], (one[1], code))]
        if size > 1:
            two = max(((score + SHRINK * (size - 2) + model[a][b][code] + model[b][code][code], way) for a, b, score, way in states), key=_score)
            after.append((code, code, two[0], ((two[1], code), code)))
        states = after
    _, way = max(((score + model[a][b][0], way) for a, b, score, way in states), key=_score)
    out = []
    while way:
        way, code = way
        out.append(chr(96 + code))
    return "".join(reversed(out))


def _score(option: tuple) -> float:
    return option[0]


class Restorer:
    """Restores texts; remembers tokens it has decoded, up to a bound."""

    def __init__(self, model: np.ndarray, counts: dict[str, int] | None = None):
        self.model = model.tolist()
        self.counts = counts or {}
        letters = [w for w in self.counts if PLAIN.fullmatch(w)]
        alike: dict[str, int] = {}
        for w in letters:
            single = RUN.sub(r"\1", w)
            alike[single] = max(alike.get(single, 0), self.counts[w])
        #: words as counted that stand as they are: plain letters, none of them doubled, or no way to read the doubled ones is
        #: so much more frequent that it could displace the word
        self.plain = frozenset(w for w in letters if not DOUBLE.search(w) or self.counts[w] >= DISGUISED * alike[RUN.sub(r"\1", w)])
        self.known: dict[str, str] = {}

    def word(self, token: str) -> str:
        core = token.strip(EDGE)
        if core == token and PLAIN.fullmatch(core) and not DOUBLE.search(core):
            return core
        return self._remembered(token, lambda: self._restore(token, core))

    def _remembered(self, seen: str, restore) -> str:
        found = self.known.get(seen)
        if found is None:
            found = restore()
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            if len(seen) <= 64:
                self.known[seen] = found
        return found

    def _restore(self, token: str, core: str) -> str:
        edge = token.strip(SEPARATORS)
        if not any("a" <= c <= "z" for c in core):
            # numbers and signs stand for themselves unless a word comes out
            found = decode(edge, self.model)
            return found if found in self.counts else core
        if core.isalpha() and not DOUBLE.search(edge) and (edge == core or len(edge) > len(core) + 2):
            return core
        # a single look-alike at the edge may belong to the word
        seen = edge if core.isalpha() and len(edge) <= len(core) + 2 else core
        found = undouble(seen, self.model) if PLAIN.fullmatch(seen) else decode(seen, self.model)
        own = self.counts.get(core, 0)
        return core if own and own >= DISGUISED * self.counts.get(found, 0) else found

    def _joined(self, tokens: list[str]) -> str:
        """Restores neighbouring short tokens together where some are no words, else one by one."""
        single = "".join("1" if len(t) == 1 else " " for t in tokens)
        strange = [t for t in tokens if t.strip(EDGE) not in self.counts]
        letters = any("a" <= c <= "z" for t in tokens for c in t)  # numbers alone are not spelled words
        if letters and (len(strange) > 1 or any(PLAIN.fullmatch(t) and len(t) > 1 for t in strange)):
            found = decode(" ".join(tokens).strip(SEPARATORS), self.model).split()
            new = set(found).difference(tokens)
            spelled = "111" in single and sum("a" <= t <= "z" for t in tokens if len(t) == 1) > 1
            if any(len(w) > 2 and w in self.counts for w in new) or spelled:
                return " ".join(found)
        return " ".join(self.word(t) for t in tokens)

    def words(self, text: str) -> Iterator[str]:
        """The words of a whole text, restored, in order."""
        for piece in _pieces(text):
            low, at = piece.lower(), 0
            for span in SHORT.finditer(low):
                for token in BLANK.findall(low[at : span.start()]):
                    yield from self.word(token).split()
                tokens = span.group().split()
                yield from self._remembered(" ".join(tokens), lambda: self._joined(tokens)).split()  # noqa: B023
                at = span.end()
            for token in BLANK.findall(low[at:]):
                yield from self.word(token).split()


    def distinct(self, text: str) -> set[str]:
        """The set of ``words``, each different token, and each different run of short ones, restored once."""
        out: set[str] = set()
        for piece in _pieces(text):
            low = piece.lower()
            parts, spans, at = [], set(), 0
            for span in SHORT.finditer(low):
                parts.append(low[at : span.start()])
                spans.add(span.group())
                at = span.end()
            parts.append(low[at:])
            tokens = set(" ".join(parts).split())
            known = tokens & self.plain
            out |= known
            for token in tokens - known:
                out.update(self.word(token).split())
            for span in spans:
                tokens_of = span.split()
                out.update(self._remembered(" ".join(tokens_of), lambda: self._joined(tokens_of)).split())  # noqa: B023
        return out


KEPT: dict[str, Restorer] = {}


def kept(key: str, letters: np.ndarray, counts: dict[str, int]) -> Restorer:
    """The worker's restorer of a model; it keeps what it remembers from task to task."""
    if key not in KEPT:
        KEPT.clear()
        KEPT[key] = Restorer(letters, counts)
    return KEPT[key]


@dataclass
class Model:
    letters: np.ndarray
    #: word: toxic and other texts that hold it, of those learned from
    words: dict[str, tuple[int, int]] = field(default_factory=dict)
    toxic: int = 0
    other: int = 0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(4))
    #: the frequent words of all texts learned from, as written
    counts: dict[str, int] = field(default_factory=dict)
    #: tells this model's restorers from others'
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def odds(self, t: int, c: int) -> float:
        return float(np.log((t + 0.2) / (self.toxic + 1)) - np.log((c + 0.2) / (self.other + 1)))

    def features(self, words: set[str], label: int | None = None) -> list[float]:
        """1, largest and summed log odds, log of the number of words. With ``label`` the text's own share is left out."""
        odds = []
        for w in words:
            if w in self.words:
                t, c = self.words[w]
                if label is not None:
                    t, c = t - label, c - (1 - label)
                if t > 0:
                    odds.append(max(self.odds(t, c), 0.0))
        return [1.0, max(odds, default=0.0), min(sum(odds), 30.0), float(np.log1p(len(words)))]


def _word_counts(model: Model):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = kept(model.key, model.letters, model.counts)
        for batch in batches:
            toxic: Counter[str] = Counter()
            other: Counter[str] = Counter()
            for text, label in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                (toxic if label else other).update(restorer.distinct(text.as_py() or ""))
            words = sorted(toxic.keys() | other.keys())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([toxic[w] for w in words], pa.int64()), pa.array([other[w] for w in words], pa.int64())], names=["word", "t", "c"])

    return count


def _own_features(model: Model):
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = kept(model.key, model.letters, model.counts)
        for batch in batches:
            labels = batch.column("toxic").to_pylist()
            rows = [model.features(restorer.distinct(t.as_py() or ""), y) for t, y in zip(batch.column("text"), labels)]
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(rows, pa.list_(pa.float64()))], names=["toxic", "f"])

    return features


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 30) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w = w + step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
    return w


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", rows: int = SAMPLE_ROWS) -> Model:
    """Learns from the rows of ``labels`` that have a row in ``docs``; letters from all of ``docs``.

    About ``rows`` labelled rows at most, chosen by hash, and the words with the largest log odds (to three places, whole classes, ``WORDS`` at most) among those in at least
    ``LEAST_TOXIC`` toxic texts. A row with several labels is toxic if one says so; null labels and ids are left out. Without labels all scores are even.
    """
    letters = letter_model(docs, text_column)
    given = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label_column).cast("int").alias("toxic")).dropna()
    given = given.groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    total = given.count()
    if total > rows:
        given = given.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < F.lit(int(1_000_000 * rows / total)))
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text")).dropna(subset=["id"])
    learned = stage(texts.join(given, "id").select("text", "toxic"), "toxic-sample")
    sizes = {r["toxic"]: r["n"] for r in learned.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    model = Model(letters, toxic=sizes.get(1, 0), other=sizes.get(0, 0), counts=word_counts(docs, text_column))
    if not model.toxic or not model.other:
        return model
    counted = learned.mapInArrow(_word_counts(model), "word string, t long, c long").groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    odds = F.round(F.log((F.col("t") + 0.2) / (F.col("c") + 0.2)), 3)
    candidates = stage(counted.where(F.col("t") >= LEAST_TOXIC).withColumn("odds", odds), "toxic-odds")
    model.words = {r["word"]: (r["t"], r["c"]) for r in largest_classes(candidates, "odds", WORDS).collect()}
    found = learned.mapInArrow(_own_features(model), "toxic int, f array<double>").collect()  # about ``rows`` rows
    found = sorted((r["toxic"], *r["f"]) for r in found)
    table = np.array(found)
    model.weights = _logistic(table[:, 1:], table[:, 0])
    return model


def _scorer(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = kept(model.key, model.letters, model.counts)
        for batch in batches:
            rows = np.array([model.features(restorer.distinct(t.as_py() or "")) for t in batch.column(1)]).reshape(-1, 4)
            p = 1 / (1 + np.exp(-np.clip(rows @ model.weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], names=["doc_id", "score"])

    return score


def _restored(letters: np.ndarray, counts: dict[str, int] | None):
    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(letters, counts)
        for batch in batches:
            texts = [None if t.as_py() is None else " ".join(restorer.words(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "restored"])

    return restore


def restore(docs: DataFrame, letters: np.ndarray, id_column: str = "doc_id", text_column: str = "text", counts: dict[str, int] | None = None) -> DataFrame:
    """Columns doc_id and restored: the words of the whole text as decoded, joined by blanks (null for null)."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(_restored(letters, counts), "doc_id long, restored string")


def scores(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Columns doc_id and score (0 to 1), one row per row. A null text counts as empty; an empty one gets the score of no words."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(_scorer(model), "doc_id long, score double")
