"""Ranked search, repeated passages of words and hard negatives: against brute force, their parts, and hard rows."""

import hashlib
import math
import os
import re
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

from tidemark.llm import dual_tree, four_russians, seed_extend  # noqa: E402
from tidemark.llm.common import ship  # noqa: E402
from tidemark.llm.queries import QUERIES, table  # noqa: E402

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


# ------------------------------------------------------------------- search


def best_documents(docs, items, most=20):
    """(item, rank, doc, score) by scoring everything; a null id ranks last."""
    tallies = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    tallies = [(d, c) for d, c in tallies if c]
    n_docs, length = len(tallies), sum(sum(c.values()) for _, c in tallies)
    holding = Counter(w for _, c in tallies for w in c)
    out = []
    for item, text in items:
        asked, found = Counter(TERM.findall((text or "").translate(LOWER))), []
        for d, c in tallies:
            m = 100 - 25 + 25 * sum(c.values()) * n_docs // length
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 12 * m)) for w, q in asked.items() if c[w])
            if score > 0:
                found.append((-score, dual_tree.NO_ID if d is None else d, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(found, key=lambda x: x[:2])[:most])]
    return Counter(out)


def test_search_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    assert Counter(map(tuple, QUERIES["op11_ranked_search"](spark, SF).collect())) == best_documents(docs, items)


def test_search_over_pages_and_trees(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    want = Counter(map(tuple, dual_tree.rank(docs, items, most=3).collect()))
    got = dual_tree.rank(docs.repartition(5), items, most=3, page=(15, 10**9), tree=(4, 10**9))
    assert Counter(map(tuple, got.collect())) == want


def test_search_on_hard_rows(spark):
    schema = "doc_id long, text string, item_id long, n int, terms string, score double"
    rows = [
        (1, "Alpha beta, beta! GAMMA größer", 9, 1, "", 0.5),
        (2, "alpha BETA beta gamma größer", None, None, None, None),
        (2, "alpha BETA beta gamma größer", None, None, None, None),
        (None, "alpha beta beta gamma größer", None, None, None, None),
        (3, None, 1, 1, "", 0.0),
        (4, "", 1, 1, "", 0.0),
        (5, " \t.,;", 1, 1, "", 0.0),
        (6, "delta " * 50_000 + "beta", 1, 1, "", 0.0),
        (7, "x" * 200_000, 1, 1, "", 0.0),
        (8, "BETA\x00beta", 1, 1, "", 0.0),
    ]
    asked = [(1, "beta alpha beta"), (1, "beta alpha beta"), (2, None), (3, "..."), (None, "größer delta"), (4, "unheard of"), (5, "x" * 200_000)]
    docs = ship(spark).createDataFrame(rows, schema)
    items = spark.createDataFrame([(i, t, "a", 1) for i, t in asked], "item_id long, text string, rank string, doc_id int")
    for most in (2, 20):
        got = Counter(map(tuple, dual_tree.rank(docs, items, most=most).collect()))
        assert got == best_documents([r[:2] for r in rows], asked, most)
    assert dual_tree.rank(docs.limit(0), items).count() == 0
    assert dual_tree.rank(docs, items.limit(0)).count() == 0


def test_bounds_prune_and_stay_exact():
    rng = np.random.default_rng(5)
    n_terms, n_items, n_docs = 60, 37, 3000
    weight = rng.integers(1, 9000, n_terms)
    # four languages of items and documents
    tallies = [{int(t): int(rng.integers(1, 3)) for t in rng.choice(15, 6, replace=False) + 15 * (i % 4)} for i in range(n_items)]
    tree = dual_tree.ItemTree.build(list(range(n_items)), tallies, weight)
    for upper, lower in zip(tree.maxima, tree.maxima[1:]):
        for node in range(upper.shape[1]):
            assert (upper[:, node] == lower[:, dual_tree.FAN * node : dual_tree.FAN * (node + 1)].max(axis=1)).all()
    assert tree.maxima[0].shape[1] == 1 and sorted(tree.numbers) == list(range(n_items))
    held = [np.sort(rng.choice(15, 5, replace=False)) + 15 * (d % 4) for d in range(n_docs)]
    values = [rng.integers(1, 10**6, 5) for _ in range(n_docs)]
    search = dual_tree.Search(tree, 10, np.zeros(n_items, dtype=np.int64))
    for at in range(0, n_docs, 2000):
        part = range(at, min(at + 2000, n_docs))
        doc = np.repeat(np.arange(len(part)), 5)
        docs = dual_tree.DocTree(doc, tree.local[np.concatenate([held[d] for d in part])], np.concatenate([values[d] for d in part]), tree)
        search.add(docs, np.array(part))
    for item, best in zip(tree.numbers, search.best):
        scores = []
        for d in range(n_docs):
            score = sum(int(v) * tallies[item].get(int(t), 0) * int(weight[t]) for t, v in zip(held[d], values[d]))
            scores.append((-score, d))
        assert sorted((-s, -me) for s, me in best) == sorted(scores)[:10]
    assert search.scored < n_items * n_docs / 8


# ------------------------------------------------------------------ repeats


def without_repeats(docs, length):
    """(doc, words, removed, digest) by looking at every window; a null id is larger than all."""
    words = [(seed_extend.NO_ID if d is None else d, d, WORD.findall(t or "")) for d, t in docs]
    first = {}
    for o, _, w in words:
        for i in range(len(w) - length + 1):
            key = tuple(w[i : i + length])
            first[key] = min(first.get(key, o), o)
    out = []
    for o, d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if first[tuple(w[i : i + length])] < o:
                gone[i : i + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def columns(frame):
    return Counter(map(tuple, frame.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()))


def test_repeats_equal_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    assert Counter(map(tuple, QUERIES["op12_substring_dedup"](spark, SF).collect())) == without_repeats(docs, 50)


def passages(rng, n, length):
    """Texts of few different words around shared passages of many lengths: seeds meet in many contexts."""
    common = [" ".join(rng.choice(["a", "b", "c"], rng.integers(length - 3, 4 * length))) for _ in range(6)]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.integers(1, 4)):
            passage = common[rng.integers(len(common))].split()
            lo = rng.integers(0, max(1, len(passage) - length + 1))
            parts += [*rng.choice(["a", "b", "c", "d"], rng.integers(0, 9)), *passage[lo : lo + rng.integers(1, 3 * length)]]
        out.append((int(i), " ".join(parts)))
    return out


@pytest.mark.parametrize("group", [2, 10**6])
def test_repeats_in_large_and_small_groups(spark, group):
    docs = passages(np.random.default_rng(6), 120, 8)
    frame = ship(spark).createDataFrame(docs, "doc_id long, text string")
    got = seed_extend.remove_repeats(frame, length=8, seed=3, group=group)
    assert columns(got) == without_repeats(docs, 8)


def test_colliding_hashes_remove_nothing(spark, monkeypatch):
    docs = passages(np.random.default_rng(7), 40, 8)
    rows = []
    known = seed_extend.WordHashes()
    monkeypatch.setattr(seed_extend.xxhash, "xxh64_intdigest", lambda word: len(word) % 2)
    docs = [(i, " ".join(w * (1 + (i + j) % 2) for j, w in enumerate(t.split()))) for i, t in docs]
    import pyarrow as pa

    for i, text in docs:
        words = text.encode().split()
        if len(words) < 8:
            continue
        hashes = np.array([known[w] for w in words], dtype=np.uint64)
        _, key, pos, lo, hi = seed_extend.seeds(hashes, np.array([len(words)]), 8, 3)
        for k, p, a, b in zip(key, pos, lo, hi):
            rows.append((int(k), i, i, int(p), int(a), int(b), int(b), b" ".join(words[p - b : p - a + 8]).decode()))
    rows.sort()
    names = ["key", "ord", "rid", "pos", "lo", "hi", "before", "words"]
    all_ = seed_extend.Stretches(pa.table(dict(zip(names, map(list, zip(*rows))))), 8, 3)
    row, start, stop = all_.finish()
    gone = {i: set() for i, _ in docs}
    for r, a, b in zip(row, start, stop):
        gone[int(all_.rid[r])] |= set(range(a, b))
    want = {d: n for d, _, n, _ in without_repeats(docs, 8)}
    assert {i: len(g) for i, g in gone.items()} == want


def test_long_texts_are_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(seed_extend, "PIECE_WORDS", 64)
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in rng.integers(0, 10**6, 1500)]
    hashes = np.array([seed_extend.WordHashes()[w.encode()] for w in words], dtype=np.uint64)
    whole = seed_extend.seeds(hashes, np.array([len(words)]), 50, 16)
    decided = sorted(s for p, lo, hi in zip(*whole[2:]) for s in range(p - hi, p - lo + 1))
    assert decided == list(range(len(words) - 49))
    pieces = []
    for start, piece in seed_extend._pieces([w.encode() for w in words], 50):
        own = np.array([seed_extend.WordHashes()[w] for w in piece], dtype=np.uint64)
        _, key, pos, lo, hi = seed_extend.seeds(own, np.array([len(piece)]), 50, 16)
        pieces += [(start + p - x, int(k), int(x)) for k, p, a, b in zip(key, pos, lo, hi) for x in range(a, b + 1)]
    assert sorted(pieces) == sorted((p - x, int(k), int(x)) for k, p, a, b in zip(*whole[1:]) for x in range(a, b + 1))


def test_repeats_on_hard_rows(spark):
    passage = " ".join(f"größe{i}" for i in range(60))
    schema = "doc_id long, text string, rid long, key string, words string, n int, ord string, tag string"
    texts = [
        (1, passage + " one"),
        (2, "two\t" + passage.replace(" ", "\n", 7)),
        (2, "two\t" + passage.replace(" ", "\n", 7)),
        (3, None),
        (None, passage + " one"),
        (None, None),
        (4, ""),
        (5, " \t "),
        (6, passage + " " + passage),
        (7, "y" * 300_000),
        (8, passage[: len(passage) // 2]),
        (9, " ".join(["again"] * 5000)),
        (10, "before " + " ".join(["again"] * 200) + " after"),
    ]
    docs = ship(spark).createDataFrame([(i, t, 1, "", "", 1, "", "") for i, t in texts], schema)
    got = seed_extend.remove_repeats(docs)
    assert columns(got) == without_repeats(texts, 50)
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in got.collect()}
    assert spans[2] == [(1, 61)] and spans[1] == [] and spans[6] == [(0, 120)] and spans[10] == [(1, 201)]
    assert columns(seed_extend.remove_repeats(docs.limit(0))) == Counter()


# ---------------------------------------------------------------- negatives


def mined(rows, anchors=100, n_pos=5, n_neg=10):
    """By Python integers over every pair. Rows are (id, vector, label)."""
    keep = []
    for number, (i, v, lab) in enumerate(rows):
        if lab is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        lab = (lab + 1) % 10 if i is not None and i % 7 == 0 else lab
        keep.append((number, i, lab, [math.floor(256 * x) for x in v]))
    last = lambda s, i: (-s, four_russians.NO_ID if i is None else i)
    out = []
    for number, i, lab, v in keep:
        if i is None or i % anchors:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, other) for k, j, other, w in keep if k != number and len(v) == len(w)]
        scored.sort(key=lambda x: last(x[0], x[1]))
        for ps, p, _ in [s for s in scored if s[2] == lab][:n_pos]:
            fits = [s for s in scored if s[2] != lab and 30 * ps <= 100 * s[0] <= 90 * ps][:n_neg]
            out += [(i, p, k + 1, n, ps, s) for k, (s, n, _) in enumerate(fits)]
    return Counter(out)


def mine(frame, **more):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return Counter(map(tuple, four_russians.hard_negatives(frame, F.col("vec_id") % 100 == 0, moved, **more).collect()))


def test_negatives_equal_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table(spark, SF, "embeddings").collect()]
    assert Counter(map(tuple, QUERIES["op13_hard_negatives"](spark, SF).collect())) == mined(rows)


def test_negatives_on_hard_rows(spark):
    rng = np.random.default_rng(9)
    rows = [(100 * (i % 9) if i < 18 else 1000 + i, [float(x) for x in rng.integers(0, 3, 9) / 8], int(rng.integers(0, 3))) for i in range(160)]
    rows += [(None, [0.25] * 9, 1), (None, [0.25] * 9, 2), (2000, None, 1), (2100, [0.5] * 9, None), (2200, [0.5, None] + [0.1] * 7, 1)]
    rows += [(2300, [float("inf")] + [0.1] * 8, 1), (2400, [float("nan")] * 9, 1), (2500, [], 1), (2600, [], 1), (2601, [], 2), (2700, [0.5, 0.5], 1)]
    rows += [(2701, [0.5, 0.5], 1), (2702, [0.25, 0.25], 2), (2800, [-0.5] * 9, 1), (2900, [0.0] * 9, 1), (3000, [5000.0] * 9, 1), (3003, [-7000.125] * 9, 2)]
    schema = "vec_id long, embedding array<double>, label int, rid string, chunk string, block int, packed string, wanted int"
    frame = ship(spark).createDataFrame([(*r, "", "", 1, "", 1) for r in rows], schema)
    want = mined(rows)
    assert mine(frame) == want and sum(want.values()) > 100
    assert mine(frame, chunk=16, block=3) == want
    assert mine(frame.limit(0)) == Counter()


def test_lookups_are_exact_products():
    rng = np.random.default_rng(10)
    for widest in (0, 1, 255, 2**40, 2**62):
        for dim in (1, 8, 13, 64):
            numbers = rng.integers(-widest, widest, (50, dim), endpoint=True)
            planes = four_russians.bit_planes(numbers)
            assert (four_russians._numbers(planes, dim) == numbers).all()
            with np.errstate(over="ignore"):
                want = (numbers * numbers[0]).sum(axis=1)
            assert (four_russians.scores(four_russians.subset_sums(numbers[0]), planes) == want).all()
    ends = four_russians.whole(np.array([[1e300, -1e300, 0.999 / 256, -1e-9]]), 256)
    assert ends.tolist() == [[2**63 - 1, -(2**63), 0, -1]]


# -------------------------------------------------------- columns with any name


def test_mixing_takes_rows_whatever_their_columns_are_called(spark):
    from tidemark.llm import mixing

    names = ["__source", "__source_size", "__target", "__whole", "__cut", "__copies", "__copy", "row", "own", "h", "size"]
    schema = "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names)
    rows = [(i, "some words of text " * (1 + i % 7), "ab"[i % 2] if i % 5 else None, *[i] * len(names)) for i in range(60)]
    docs = ship(spark).createDataFrame(rows, schema)
    plain = docs.select("doc_id", "text", "source")
    want = Counter(r["doc_id"] for r in mixing.take(plain).collect())
    got = mixing.take(docs)
    assert got.columns == docs.columns
    taken = got.collect()
    assert Counter(r["doc_id"] for r in taken) == want and all(r["__cut"] == r["doc_id"] == r["h"] for r in taken)


def test_large_classes_are_collected_whole(spark):
    from tidemark.llm.common import largest_classes

    values = [9, 9, 7, 7, 7, 3, 2, 2, 2, 2, 1, 0, -4, -4]
    frame = spark.createDataFrame([(float(v),) for v in values], "n double").repartition(5)
    for limit, want in ((0, 0), (1, 0), (2, 2), (4, 2), (5, 5), (6, 6), (9, 6), (10, 10), (13, 12), (14, 14), (99, 14)):
        assert sorted((r["n"] for r in largest_classes(frame, "n", limit).collect()), reverse=True) == values[:want]


def test_steps_of_a_large_group_make_rows_in_proportion():
    """Copies with words of their own at chance places: twice the copies, twice the rows of all steps, not four times."""
    import pyarrow as pa


    def rows_made(n):
        chosen = np.random.default_rng(7)
        words = np.array([f"w{i}" for i in range(84)], dtype=object)
        texts = []
        for _ in range(n):
            mine = words.copy()
            at = chosen.choice([i for i in range(84) if not 34 <= i < 50], 3, replace=False)
            mine[at] = [f"x{i}" for i in chosen.integers(0, 1000, 3)]
            texts.append(" ".join(mine))
        zero, at = np.zeros(n, dtype=np.int64), np.full(n, 34, dtype=np.int32)
        ids = pa.array(np.arange(n, dtype=np.int64))
        columns = [pa.array(zero), ids, ids, pa.array(at), pa.array(np.zeros(n, dtype=np.int32)), pa.array(at), pa.array(at), pa.array(texts)]
        stretches = seed_extend.Stretches(pa.table(columns, names=["key", "ord", "rid", "pos", "lo", "hi", "before", "words"]), 50, 16)
        made, plain = [], stretches.step

        def counted(*given):
            found, more = plain(*given)
            made.append(len(found[0]) + len(more[0]))
            return found, more

        stretches.step = counted
        stretches.finish()
        return sum(made)

    counts = [rows_made(n) for n in (1000, 2000, 4000, 8000)]
    print(counts)
    assert all(b < 2.5 * a for a, b in zip(counts, counts[1:]))
