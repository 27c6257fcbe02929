"""The registered queries on the smallest tables against brute force, exact round trips and held-out accuracy."""

import hashlib
import os
import re
import sys
import zlib

import numpy as np
import pytest
import xxhash

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

from tidemark.llm.queries import QUERIES, table, vocabulary  # noqa: E402

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def documents(spark):
    rows = table(spark, SF, "documents").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def result(spark, name):
    return QUERIES[name](spark, SF).collect()


def components(ids, links):
    root = {i: i for i in ids}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def test_embedding_links(spark):
    rows = table(spark, SF, "embeddings").collect()
    vectors = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in rows}
    label = {r["vec_id"]: r["label"] for r in rows}
    ids = sorted(vectors)
    unit = np.array([vectors[i] / np.linalg.norm(vectors[i]) for i in ids])
    near = unit @ unit.T >= 0.98
    links = [(ids[i], ids[j]) for i in range(len(ids)) for j in range(i) if near[i, j] and label[ids[i]] == label[ids[j]] and label[ids[i]] is not None]
    want = components(ids, links)
    degree = {i: 0 for i in ids}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in result(spark, "op1_embedding_near_dedup")}
    assert got == {i: (degree[i], want[i], want[i] == i) for i in ids}


def test_mixing_comes_near_its_targets(spark, documents):
    rows = result(spark, "op2_source_mixing")
    assert {r["doc_id"]: r["size"] for r in rows} == {d: len(WORD.findall(t)) for d, t in documents.items()}
    taken, largest, target = {}, {}, {}
    for r in rows:
        key = r["source_size"], r["target"]
        taken[key] = taken.get(key, 0) + r["taken"]
        largest[key] = max(largest.get(key, 0), r["size"])
        assert r["taken"] <= 3 * r["size"]
    for key in taken:
        assert abs(taken[key] - key[1]) <= largest[key]


def test_repeated_passages(spark, documents):
    raw = {d: t.encode() for d, t in documents.items()}
    first = {}
    for d in sorted(raw, reverse=True):
        for i in range(len(raw[d]) - 49):
            first[raw[d][i : i + 50]] = d
    want = set()
    for d, r in raw.items():
        mark = bytearray(len(r))
        for i in range(len(r) - 49):
            if first[r[i : i + 50]] < d:
                mark[i : i + 50] = b"\1" * 50
        kept = bytes(b for b, m in zip(r, mark) if not m)
        want.add((d, len(r), sum(mark), len(re.findall(b"\1+", mark)), hashlib.sha256(kept).hexdigest()))
    assert {tuple(r) for r in result(spark, "op3_suffix_dedup")} == want


def test_scores_and_their_base(spark, documents):
    counts, n = {}, 0
    for d, t in documents.items():
        if zlib.crc32(str(d).encode()) % 7 != 2:
            for w in [*WORD.findall(t.translate(LOWER)), ""]:
                counts[w] = counts.get(w, 0) + 1
                n += 1
    for r in result(spark, "op4_attention_scores"):
        words = [*WORD.findall(documents[r["doc_id"]].translate(LOWER)), ""]
        c = np.array([counts.get(w, 0) for w in words])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), int((c > 0).sum()), n)
        assert r["base_score"] == pytest.approx(np.log10((c + 1) / (n + len(counts) + 1)).sum(), rel=1e-9)
        assert r["score"] < 0 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)


def _tokens(documents, name, end):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary(name))
    return {d: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, end], dtype="<u4") for d, t in documents.items()}


def test_token_files_round_trip(spark, documents):
    want, start = [], 0
    ids = _tokens(documents, "byte_bpe_50k.json", 0)
    for d in sorted(ids):
        want.append((d, start, len(ids[d]), zlib.crc32(ids[d].tobytes())))
        start += len(ids[d])
    assert sorted(tuple(r)[:4] for r in result(spark, "op5_token_files")) == want


def test_language_accuracy_on_held_out(spark):
    lang = {r["doc_id"]: r["lang"] for r in table(spark, SF, "documents").collect()}
    rows = [r for r in result(spark, "op6_language_id") if r["held_out"] and lang[r["doc_id"]]]
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in rows]) >= 0.9


def test_simhash_classes(spark, documents):
    prints = {}
    for d, t in documents.items():
        words = WORD.findall(t.translate(LOWER))
        k = min(3, len(words))
        h = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)] if words else []
        prints[d] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    ids = sorted(prints)
    links = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    want = components(ids, links)
    assert {tuple(r)[:3] for r in result(spark, "op7_simhash_near_dedup")} == {(d, f"{prints[d]:016x}", want[d]) for d in ids}


def test_fingerprints_of_edited_texts(spark, documents):
    order = sorted(documents, reverse=True)
    follower = dict(zip(order, order[1:] + order[:1]))
    rows = result(spark, "op8_closed_syncmers")
    prints = {}
    for r in rows:
        text, other = documents[r["doc_id"]], documents[follower[r["doc_id"]]]
        n = len(text) // 3
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256((text[: len(text) - n] + other[:n]).encode()).hexdigest()
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
    assert np.mean([r["near_edited"] for r in rows]) > 0.4 and np.mean([r["near_next"] for r in rows]) < 0.05


def test_packing_is_whole_and_tight(spark, documents):
    ids = _tokens(documents, "word_bpe_49k.json", 1)
    rows = result(spark, "op9_pattern_packing")
    pieces, sequences = {}, {}
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["start"] == 4096 * r["piece"]
        pieces[r["doc_id"]] = pieces.get(r["doc_id"], 0) + r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert pieces == {d: len(i) for d, i in ids.items()}
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(sequences) <= -(-sum(pieces.values()) // 4096) * 1.05 + 1


def test_toxicity_on_held_out(spark):
    sf = "/root/testdata/sf0.01"
    toxic = {r["doc_id"]: r["toxic"] for r in table(spark, sf, "labels").collect()}
    rows = QUERIES["op10_deobfuscated_toxicity"](spark, sf).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [(r["score"], toxic[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in toxic]
    yes, no = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([[a > b or (a == b) / 2 for b in no] for a in yes]) > 0.8
