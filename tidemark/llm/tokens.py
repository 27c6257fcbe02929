"""Token ids of public tokenizers, computed word by word through a bounded memory of words already seen.

Both tokenizers cut a text at white space before merging: one keeps a single blank in front of a word and cuts it there, the other
drops blanks. Ids of the pieces in order are therefore the ids of the whole text. Arrow cuts the texts and numbers their pieces, and each different
piece of a portion costs a lookup instead of a run of merges. Texts that may hold one of the added tokens go to the tokenizer whole.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.common import KEPT

#: The characters of Unicode's White_Space property.
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A word with the one blank before it; or blanks but for the last before a word.
BYTE_LEVEL = re.compile(f" ?[^{BLANKS}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+")
WORD_LEVEL = re.compile(f"[^{BLANKS}]+")
#: Blanks that Arrow does not cut at.
OTHER_BLANKS = "[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Texts whose pieces are not told by their spaces alone: a blank beside a space, or at an end.
BESIDE = f" [{BLANKS}]|[{BLANKS}] |^[{BLANKS}]|[{BLANKS}]$"
ANY_BLANK = f"[{BLANKS}]"
PATTERNS = {"byte": BYTE_LEVEL, "word": WORD_LEVEL}

#: Words and ids remembered by a worker; beyond them it starts anew.
REMEMBERED_WORDS = 300_000
REMEMBERED_IDS = 4_000_000
LONGEST_REMEMBERED = 64
#: Unknown words encoded in one go.
TOGETHER = 8_000


class Encoder:
    """Ids of texts: ``Encoder(path, "byte")`` for a byte-level vocabulary, ``"word"`` for one that drops blanks."""

    def __init__(self, path: str, kind: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind, self.pattern = kind, PATTERNS[kind]
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # both vocabularies write a byte as one character, and may mark the end of a word
        mark = getattr(self.tokenizer.model, "end_of_word_suffix", None) or ""
        known = self.tokenizer.get_vocab(with_added_tokens=True)
        self.widths = np.zeros(max(known.values()) + 1, dtype=np.int64)
        for token, number in known.items():
            self.widths[number] = len(token.removesuffix(mark))
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.ends = array("I"), array("q", [0])
        self.seen = np.zeros(0, dtype=np.int64)
        self._keep("", b"")

    def _forget(self) -> None:
        """Keep the words met most often, half of the room at most."""
        words, number = list(self.number), np.fromiter(self.number.values(), dtype=np.int64, count=len(self.number))
        times = self.seen[number]
        flat, ends = np.array(self.flat, dtype=np.uint32), np.array(self.ends, dtype=np.int64)
        least = 2
        while (times >= least).sum() > REMEMBERED_WORDS // 2 or (np.diff(ends)[number] * (times >= least)).sum() > REMEMBERED_IDS // 2:
            least *= 2
        kept = np.flatnonzero(times >= least)
        first, lengths = ends[number[kept]], np.diff(ends)[number[kept]]
        after = np.cumsum(lengths)
        self._clear()
        known = {words[i]: n for n, i in enumerate(kept.tolist(), 1)}
        self.number = {**known, "": 0}
        if len(kept):
            self.flat.frombytes(flat[np.arange(after[-1]) + np.repeat(first - (after - lengths), lengths)].tobytes())
            self.ends.frombytes(after.astype(np.int64).tobytes())
        self.seen = np.concatenate(([0], times[kept] // 2))

    def _keep(self, piece: str, ids: bytes) -> None:
        self.number[piece] = len(self.ends) - 1
        self.flat.frombytes(ids)
        self.ends.append(len(self.flat))

    def _learn(self, pieces: list[str]) -> None:
        joined, alone = [], []
        for piece in pieces:
            (joined if self._joins(piece) else alone).append(piece)
        for at in range(0, len(joined), TOGETHER):
            part = joined[at : at + TOGETHER]
            bounds, ids = self._together(part)
            if bounds is None:
                alone += part
                continue
            known, base = len(self.ends) - 1, len(self.flat)
            self.number.update(zip(part, range(known, known + len(part))))
            self.flat.frombytes(ids.tobytes())
            self.ends.frombytes((bounds[1:] + base).tobytes())
        for at in range(0, len(alone), 10_000):
            part = alone[at : at + 10_000]
            for piece, found in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self._keep(piece, np.array(found.ids, dtype=np.uint32).tobytes())

    def _joins(self, piece: str) -> bool:
        """Words that the tokenizer cuts off from what stands before them."""
        return len(piece) <= LONGEST_REMEMBERED and (self.kind == "word" or (piece[0] == " " and piece[-1] != " "))

    def _together(self, pieces: list[str]) -> tuple[np.ndarray | None, np.ndarray]:
        """Ids of several words encoded as one text, and where each word's begin. An id stands for a known number of bytes, so the words'
        lengths tell their ids apart; None where they do not."""
        text = " ".join(pieces) if self.kind == "word" else "".join(pieces)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)
        normal = self.tokenizer.normalizer
        foreign = [p for p in pieces if not p.isascii()]
        if normal and foreign:
            together = normal.normalize_str(" ".join(foreign)).split(" ")
            foreign = together if len(together) == len(foreign) else [normal.normalize_str(p) for p in foreign]
        written = iter(foreign)
        sizes = [len(p) if p.isascii() else len(next(written).encode()) for p in pieces]
        after = np.concatenate(([0], np.cumsum(self.widths[ids])))
        ends = np.concatenate(([0], np.cumsum(sizes)))
        bounds = np.searchsorted(after, ends)
        if bounds[-1] != len(ids) or (after[np.minimum(bounds, len(after) - 1)] != ends).any():
            return None, ids
        return bounds.astype(np.int64), ids

    def _regular(self, texts: pa.Array) -> np.ndarray:
        """Which texts Arrow cuts as the tokenizer does."""
        # an added token inside a text is cut out before anything else: such a text stays whole
        odd = np.zeros(len(texts), dtype=bool)
        for token in self.added:
            odd |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if self.kind == "byte":
            odd |= pc.match_substring_regex(texts, BESIDE).to_numpy(zero_copy_only=False)
        else:
            foreign = np.flatnonzero(~pc.string_is_ascii(texts).to_numpy(zero_copy_only=False))
            odd[foreign] |= pc.match_substring_regex(texts.take(pa.array(foreign)), OTHER_BLANKS).to_numpy(zero_copy_only=False)
        return ~odd

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str], list[int]]:
        """Pieces a text, the pieces as numbers into a list of different ones, that list, and which of it hold several pieces."""
        lists = pc.split_pattern(texts, " ") if self.kind == "byte" else pc.ascii_split_whitespace(texts)
        counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        words = coded.dictionary.to_pylist()
        if self.kind == "word":
            return counts, which, words, []
        # all but a text's first word have a blank before them
        first = np.zeros(len(which), dtype=bool)
        first[(np.cumsum(counts) - counts)[counts > 0]] = True
        starts, at = np.unique(which[first], return_inverse=True)
        several = np.flatnonzero(pc.match_substring_regex(coded.dictionary, ANY_BLANK).to_numpy(zero_copy_only=False))
        several = several.tolist() + (len(words) + np.flatnonzero(np.isin(starts, several))).tolist()
        which[first] = len(words) + at
        inside = np.zeros(len(words), dtype=bool)
        inside[which[~first]] = True
        # a word only met at the start of a text needs no lookup with a blank
        found = [" " + word if within else "" for word, within in zip(words, inside.tolist())]
        return counts, which, found + [words[i] for i in starts.tolist()], several

    def encode(self, texts: list[str | None] | pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids as uint32, and the bounds of each text in them (one more than texts). ``end_id`` follows each text."""
        if len(self.number) > REMEMBERED_WORDS or len(self.flat) > REMEMBERED_IDS:
            self._forget()
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).fill_null("")
        regular = self._regular(texts)
        counts = np.zeros(len(texts), dtype=np.int64)
        counts[regular], cut, words, several = self._cut(texts.filter(pa.array(regular)))
        rest: list[str] = []
        for i in np.flatnonzero(~regular).tolist():
            text = texts[i].as_py()
            found = [text] if any(a in text for a in self.added) else self.pattern.findall(text)
            counts[i] = len(found)
            rest += found
        lines = {words[i]: self.pattern.findall(words[i]) for i in several if words[i]}
        wanted = dict.fromkeys([*words, *rest, *(part for found in lines.values() for part in found)])
        new = [piece for piece in wanted if piece not in self.number and piece not in lines]
        if new:
            self._learn(new)
        for line, found in lines.items():
            ids = (self.flat[self.ends[n] : self.ends[n + 1]].tobytes() for n in map(self.number.__getitem__, found))
            self._keep(line, b"".join(ids))
        numbered = np.fromiter(map(self.number.__getitem__, words), dtype=np.int64, count=len(words))
        which = np.empty(int(counts.sum()), dtype=np.int64)
        whole = np.repeat(regular, counts)
        which[whole] = numbered[cut]
        which[~whole] = np.fromiter(map(self.number.__getitem__, rest), dtype=np.int64, count=len(rest))
        times = np.bincount(which, minlength=len(self.ends) - 1)
        times[: len(self.seen)] += self.seen
        self.seen = times
        flat, ends = np.frombuffer(self.flat, dtype=np.uint32), np.frombuffer(self.ends, dtype=np.int64)
        first, lengths = ends[which], ends[which + 1] - ends[which]
        after = np.cumsum(lengths)
        if len(which):
            ids = flat[np.arange(after[-1]) + np.repeat(first - (after - lengths), lengths)]
        else:
            ids = np.zeros(0, dtype=np.uint32)
        bounds = np.concatenate(([0], np.concatenate(([0], after))[np.cumsum(counts)])).astype(np.int64)
        del flat, ends
        # text lines, and pieces too long to be worth it, are not remembered
        for piece in [*lines, *(p for p in new if len(p) > LONGEST_REMEMBERED)]:
            self.number.pop(piece, None)
        if end_id is not None:
            ids = np.insert(ids, bounds[1:], end_id)
            bounds = bounds + np.arange(len(bounds))
        return ids, bounds


@lru_cache(maxsize=4)
def encoder(path: str, kind: str) -> Encoder:
    """The worker's encoder; it is kept from task to task."""
    return Encoder(path, kind)


KEPT.append(encoder.cache_clear)
