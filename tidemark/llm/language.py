"""Language of a text by a convolutional network over its bytes.

Bytes are embedded, filters of several widths slide over fixed-length windows, the largest response of each filter goes to
a softmax over the learned languages. The network is trained in numpy with Adam on a bounded sample of the labelled rows of each language, the ones
with the smallest hashes; a text's answer is the mean of the probabilities of all its windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import hand_back

WINDOW = 256
WIDTHS = (2, 3, 5)
FILTERS = 24
EMBED = 8
#: Bounds of what is fitted on: rows of each language, and pieces of each row (spread over the whole text).
SAMPLE_ROWS = 500
SAMPLE_WINDOWS = 4
EPOCHS = 6
BATCH = 64
UNKNOWN = "und"
#: From this mean probability on the answer stands against a row's own language.
CERTAIN = 0.95
#: Byte 0 fills up the last window.
PAD = 0


def windows(text: str) -> np.ndarray:
    """The whole text's UTF-8 bytes in rows of ``WINDOW``; a short rest is joined to the last full window by overlap."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if len(raw) <= WINDOW:
        out = np.full((1, WINDOW), PAD, dtype=np.uint8)
        out[0, : len(raw)] = raw
        return out
    starts = np.append(np.arange(0, len(raw) - WINDOW, WINDOW), len(raw) - WINDOW)
    return np.lib.stride_tricks.sliding_window_view(raw, WINDOW)[starts]


class Network:
    def __init__(self, languages: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.w: dict[str, np.ndarray] = {"embed": rng.normal(0, 0.3, (256, EMBED)).astype(np.float32)}
        for width in WIDTHS:
            self.w[f"f{width}"] = rng.normal(0, 0.25, (width * EMBED, FILTERS)).astype(np.float32)
            self.w[f"b{width}"] = np.zeros(FILTERS, dtype=np.float32)
        self.w["out"] = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32)
        self.w["bias"] = np.zeros(len(languages), dtype=np.float32)

    def _patches(self, x: np.ndarray, width: int) -> np.ndarray:
        n = WINDOW - width + 1
        return np.concatenate([x[:, i : i + n] for i in range(width)], axis=2)

    def _pooled(self, rows: np.ndarray):
        x = self.w["embed"][rows]
        features, kept = [], []
        for width in WIDTHS:
            patches = self._patches(x, width)
            reply = patches @ self.w[f"f{width}"] + self.w[f"b{width}"]
            best = reply.argmax(axis=1)
            value = np.take_along_axis(reply, best[:, None], axis=1)[:, 0]
            features.append(np.maximum(value, 0))
            kept.append((patches, best, value))
        return np.concatenate(features, axis=1), kept

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        out = []
        for at in range(0, len(rows), BATCH):
            x = self.w["embed"][rows[at : at + BATCH]]
            features = []
            for width in WIDTHS:
                # one small product per filter place instead of wide patches
                n = WINDOW - width + 1
                f = self.w[f"f{width}"].reshape(width, EMBED, FILTERS)
                reply = x[:, :n] @ f[0]
                for i in range(1, width):
                    reply += x[:, i : i + n] @ f[i]
                features.append(np.maximum(reply.max(axis=1) + self.w[f"b{width}"], 0))
            out.append(_softmax(np.concatenate(features, axis=1) @ self.w["out"] + self.w["bias"]))
        return np.concatenate(out)

    def step(self, rows: np.ndarray, goal: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy."""
        features, kept = self._pooled(rows)
        error = _softmax(features @ self.w["out"] + self.w["bias"])
        error[np.arange(len(goal)), goal] -= 1
        error /= len(goal)
        grads = {"out": features.T @ error, "bias": error.sum(axis=0), "embed": np.zeros_like(self.w["embed"])}
        back = error @ self.w["out"].T
        line = np.arange(len(rows))
        for i, width in enumerate(WIDTHS):
            patches, best, value = kept[i]
            part = back[:, i * FILTERS : (i + 1) * FILTERS] * (value > 0)
            chosen = patches[line[:, None], best]  # row, filter, width * EMBED
            grads[f"f{width}"] = np.einsum("rfk,rf->kf", chosen, part)
            grads[f"b{width}"] = part.sum(axis=0)
            to_patch = part[:, :, None] * self.w[f"f{width}"].T[None]
            to_patch = to_patch.reshape(len(rows), FILTERS, width, EMBED)
            for j in range(width):
                np.add.at(grads["embed"], rows[line[:, None], best + j], to_patch[:, :, j])
        return grads

    def fit(self, rows: np.ndarray, goal: np.ndarray, epochs: int = EPOCHS, rate: float = 0.005, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.w.items()}
        square = {k: np.zeros_like(v) for k, v in self.w.items()}
        t = 0
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), BATCH):
                part = order[at : at + BATCH]
                t += 1
                for name, grad in self.step(rows[part], goal[part]).items():
                    mean[name] = 0.9 * mean[name] + 0.1 * grad
                    square[name] = 0.99 * square[name] + 0.01 * grad * grad
                    scaled = mean[name] / (1 - 0.9**t) / (np.sqrt(square[name] / (1 - 0.99**t)) + 1e-8)
                    self.w[name] = (self.w[name] - rate * scaled).astype(np.float32)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", rows: int = SAMPLE_ROWS) -> Network | None:
    """Fits the network on at most ``rows`` rows of each language with a letter in their text; None where there is no such row.

    Of every text at most ``SAMPLE_WINDOWS`` pieces are taken, from places spread over all of it, and all windows of each.
    """
    size = F.length("text")
    pieces = F.array(*[F.expr(f"substring(text, cast(greatest(length(text) - {WINDOW}, 0) * {i} / {SAMPLE_WINDOWS - 1} as int) + 1, {WINDOW})") for i in range(SAMPLE_WINDOWS)])
    given = docs.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).cast("string").alias("text"), F.col(lang_column).cast("string").alias("lang"))
    given = given.where("lang IS NOT NULL AND text IS NOT NULL").where((size > 0) & F.col("text").rlike(r"\p{L}")).select(F.xxhash64("id", "text").alias("h"), "lang", pieces.alias("pieces"))
    ranked = given.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("place") <= rows)
    found = sorted(ranked.select("h", "lang", "pieces").collect(), key=lambda r: (r["h"], r["lang"]))
    found = [(r["lang"], p) for r in found for p in dict.fromkeys(r["pieces"]) if has_letter(p)]
    if not found:
        return None
    languages = sorted({lang for lang, _ in found})
    network = Network(languages)
    number = {lang: i for i, lang in enumerate(languages)}
    cut = [(number[lang], windows(p)) for lang, p in found]
    network.fit(np.concatenate([w for _, w in cut]), np.repeat([i for i, _ in cut], [len(w) for _, w in cut]))
    return network


def _predictor(network: Network | None):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for value in batch.column(1):
                text = value.as_py()
                if network is None or not has_letter(text):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                rows = windows(text)
                total = np.zeros(len(network.languages))
                for at in range(0, len(rows), 1024):
                    total += network.probabilities(rows[at : at + 1024]).sum(axis=0)
                total = np.clip(total / len(rows), 0.0, 1.0)
                best = int(total.argmax())
                langs.append(network.languages[best])
                scores.append(float(total[best]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return predict


def fold(id_column: str, parts: int):
    """The remainder of crc32 of the id as text (a null id as an empty text)."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % parts


def identify(docs: DataFrame, network: Network | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Columns doc_id, lang_pred and score (mean probability over the whole text's windows), one row per row.

    A null text, a text without a letter, and every text where nothing could be learned, is ``und`` with score 0.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(_predictor(network), "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, network: Network | None, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """All rows of ``docs`` whose text has a letter, with the network's answer in ``lang_column`` where it decides.

    It decides where the row has no language, and where it gives at least ``CERTAIN`` to another language than the row's and
    the row's is one it has learned. Where nothing could be learned, languages stay as they are. Column names may be any.
    """
    name = "answer"
    while name in docs.columns:
        name += "_"
    quote = lambda c: F.col("`" + c.replace("`", "``") + "`")
    answer = F.pandas_udf(_identified(network), "kept boolean, lang string").asNondeterministic()  # evaluated once
    found = docs.withColumn(name, answer(quote(text_column).cast("string"), quote(lang_column).cast("string")))
    kind = docs.schema[lang_column].dataType
    return found.where(F.col(name)["kept"]).select(*[F.col(name)["lang"].cast(kind).alias(c) if c == lang_column else quote(c) for c in docs.columns])


def _identified(network: Network | None):
    def identified(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        hand_back()
        for texts, langs in batches:
            yield answers(texts, langs)

    def answers(texts: pd.Series, langs: pd.Series) -> pd.DataFrame:
        texts = [t if isinstance(t, str) else None for t in texts]
        langs = [x if isinstance(x, str) else None for x in langs]
        kept = [has_letter(t) for t in texts]
        if network is not None:
            batch = pa.RecordBatch.from_arrays([pa.array([0] * len(texts), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
            found = next(_predictor(network)(iter([batch])))
            for i, (best, score) in enumerate(zip(found.column("lang_pred").to_pylist(), found.column("score").to_pylist())):
                if best != UNKNOWN and (langs[i] is None or score >= CERTAIN and langs[i] in network.languages):
                    langs[i] = best
        return pd.DataFrame({"kept": pd.Series(kept, dtype=bool), "lang": pd.Series(langs, dtype=object)})

    return identified
