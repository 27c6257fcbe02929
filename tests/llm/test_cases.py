"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns; the parts of each method; the pipeline's stages."""

import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

import corpus_pipeline  # noqa: E402
from tidemark.llm import attention, cap_filters, language, mixing, packing, simhash, suffixes, syncmers, token_files, toxicity  # noqa: E402
from tidemark.llm.common import ship, vocabulary  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid string, h string, size int, label int"
PASSAGE = "a passage of well over fifty bytes that several of the documents in this table have in common, word by word. "
LONG = " ".join(f"word{i} größer" for i in range(20_000))
ROWS = [
    (1, PASSAGE + "one", "en", "a", 1, "x", "x", 1, 1),
    (2, "two " + PASSAGE, "en", "b", None, None, None, None, None),
    (2, "two " + PASSAGE, "en", "b", None, None, None, None, None),
    (3, None, None, None, None, None, None, None, None),
    (None, PASSAGE + "one", "en", None, 5, "y", "y", 2, 2),
    (None, None, None, None, None, None, None, None, None),
    (4, "", "en", "a", 0, "", "", 0, 0),
    (5, "  \t ", "de", "a", 3, "", "", 0, 0),
    (6, LONG, "de", "c", 9, "", "", 0, 0),
    (7, LONG + " Ende", "de", "c", 9, "", "", 0, 0),
    (8, "1234 !!", "fr", "a", 3, "", "", 0, 0),
]


@pytest.fixture(scope="module")
def docs(spark):
    return ship(spark).createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return ship(spark).createDataFrame([], SCHEMA)


def test_suffix_cases(docs, empty):
    assert suffixes.remove_repeats(empty).count() == 0
    rows = suffixes.remove_repeats(docs, keep_text=True).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        if r["doc_id"] == 2:  # both rows lose the passage to row 1, none to each other
            assert r["n_removed"] == len(PASSAGE) and r["kept_text"] == "two "
        if r["doc_id"] in (3, 4):
            assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (0, 0, 0)
    none = [r for r in rows if r["doc_id"] is None and r["n_bytes"]]
    assert none[0]["n_removed"] == none[0]["n_bytes"]
    seven = next(r for r in rows if r["doc_id"] == 7)
    assert seven["kept_text"] == " Ende" and seven["n_spans"] == 1


def test_suffix_sort_survives_collisions():
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 99, 600).astype(np.uint8)
    raw[300:400] = raw[100:200]
    starts, bounds = np.arange(500), np.array([0, 250, 500])
    windows = [raw[s : s + 50].tobytes() for s in starts]

    def check(found):
        for lo, hi in ((0, 250), (250, 500)):
            for i in range(lo, hi):
                for j in range(lo, i):
                    assert (found[i] == found[j]) == (windows[i] == windows[j])

    good = suffixes.Suffixes(raw, starts, bounds)
    order = good.order()
    for lo, hi in ((0, 250), (250, 500)):
        assert [windows[i] for i in order[lo:hi]] == sorted(windows[lo:hi])
    check(good.classes())
    broken = suffixes.Suffixes(raw, starts, bounds)
    broken.prefix = np.zeros_like(broken.prefix)  # every hash collides
    check(broken.classes())


def test_suffixes_that_differ_early_are_not_compared(monkeypatch):
    rng = np.random.default_rng(2)
    raw = rng.integers(0, 256, 5000).astype(np.uint8)
    starts, bounds = np.arange(4900), np.array([0, 0, 2000, 2001, 4900, 4900])
    windows = [raw[s : s + 50].tobytes() for s in starts]
    compared = []
    above = suffixes.Suffixes.above
    monkeypatch.setattr(suffixes.Suffixes, "above", lambda self, a, b: (compared.append(len(a)), above(self, a, b))[1])
    order = suffixes.Suffixes(raw, starts, bounds).order()
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        assert [windows[i] for i in order[lo:hi]] == sorted(windows[lo:hi])
    assert sum(compared) == 0
    # a passage that comes again is compared with itself only
    raw[4000:4200] = raw[100:300]
    windows = [raw[s : s + 50].tobytes() for s in starts]
    order = suffixes.Suffixes(raw, starts).order()
    assert [windows[i] for i in order] == sorted(windows)
    assert 0 < sum(compared) <= 2 * 200


def test_split_groups_agree(docs, monkeypatch):
    want = sorted(map(tuple, suffixes.remove_repeats(docs).select("doc_id", "n_removed", "kept_sha256").fillna(-1).collect()))
    monkeypatch.setattr(suffixes, "GROUP", 1)
    assert sorted(map(tuple, suffixes.remove_repeats(docs).select("doc_id", "n_removed", "kept_sha256").fillna(-1).collect())) == want


def test_simhash_cases(docs, empty):
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.near_duplicates(docs).count() == len(ROWS)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    # texts without words are one class; the null id gives way to row 1; repeated rows leave one
    assert sorted(r["doc_id"] for r in kept.collect()) in ([1, 2, 3, 6, 8], [1, 2, 3, 6, 7, 8])


def test_every_triple_is_covered():
    for i in range(0, 64, 7):
        for j in range(64):
            assert any(not m >> i & 1 and not m >> j & 1 and not m & 1 for m in simhash.MASKS)


def test_language_cases(docs, empty):
    assert language.train(empty) is None
    assert {r["lang_pred"] for r in language.identify(docs, None).collect()} == {"und"}
    network = language.train(docs)
    rows = language.identify(docs, network).collect()
    assert len(rows) == len(ROWS)
    assert [r["lang_pred"] for r in rows if r["doc_id"] in (3, 4, 5, 8)] == ["und"] * 4
    assert language.keep_identified(docs, network).count() == 6


def test_language_stage_uses_the_answer(spark):
    german, english = "der Hund und die Katze sind nicht in dem Haus ", "the dog and the cat are not in this house "
    rows = [(i, (german if i % 2 else english) * (1 + i % 9), "de" if i % 2 else "en") for i in range(300)]
    rows += [(1000, german * 3, None), (1001, english * 3, None), (1002, german * 3, "en"), (1003, english * 3, "nl"), (1004, "12 34", "en")]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string, lang string")
    network = language.train(docs.where("doc_id < 1000"))
    got = {r["doc_id"]: r["lang"] for r in language.keep_identified(docs, network).collect()}
    # missing ones are filled, a wrong one is corrected, one that was not learned stays, a text without letters goes
    assert {i: got.get(i) for i in range(1000, 1005)} == {1000: "de", 1001: "en", 1002: "de", 1003: "nl", 1004: None}
    assert len(got) == 304
    # where nothing could be learned, texts with letters stay
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language_id(spark, unlabelled, "").count() == 304


def test_rare_languages_and_all_windows_are_learned(spark, monkeypatch):
    rows = [(i, f"common words {i}", "en") for i in range(3000)] + [(9000, "слово " * 40, "ru")]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string, lang string")
    fitted = []
    monkeypatch.setattr(language.Network, "fit", lambda self, rows, goal: fitted.append((self.languages, rows, goal)))
    language.train(docs, rows=20)
    languages, windows, goal = fitted[0]
    assert languages == ["en", "ru"] and (goal == 0).sum() == 20
    assert (goal == 1).sum() == len(language.windows(rows[-1][1])) > 1 and len(windows) == len(goal)


def test_language_gradients():
    network = language.Network(["a", "b"], seed=1)
    network.w = {k: v.astype(np.float64) for k, v in network.w.items()}
    rows, goal = np.random.default_rng(2).integers(0, 256, (3, language.WINDOW)), np.array([0, 1, 1])
    grads = network.step(rows, goal)

    def loss():
        return -np.log(network.probabilities(rows)[np.arange(3), goal]).mean()

    for name in ("f3", "out", "embed"):
        spot = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        network.w[name][spot] += 1e-5
        up = loss()
        network.w[name][spot] -= 2e-5
        assert (up - loss()) / 2e-5 == pytest.approx(grads[name][spot], rel=1e-2)
        network.w[name][spot] += 1e-5


def test_attention_cases(docs, empty):
    path = vocabulary("byte_bpe_50k.json")
    assert attention.score(empty, empty, path).count() == 0
    rows = attention.score(docs, docs.where("doc_id < 5"), path, frequent_words=2).collect()
    assert len(rows) == len(ROWS)
    assert all(r["score"] < 0 and np.isfinite(r["base_score"]) for r in rows)
    same = {r["score"] for r in rows if r["n_tokens"] == 1 and r["doc_id"] in (3, 4)}
    assert len(same) == 1
    # two frequent words or all of them: the same counts
    other = attention.score(docs, docs.where("doc_id < 5"), path).collect()
    key = lambda r: (r["doc_id"] or 0, r["n_tokens"], r["n_known"], round(r["base_score"], 6))
    assert sorted(map(key, rows)) == sorted(map(key, other))


def test_attention_is_causal_and_sums_to_one():
    counts = np.random.default_rng(0).integers(0, 50, attention.VOCABULARY).astype(float)
    inputs, classes, within = attention.id_classes(counts)
    assert np.bincount(classes, weights=np.exp(within)) == pytest.approx(np.ones(attention.CLASSES))
    net = attention.Attention(inputs, classes)
    a = np.random.default_rng(1).integers(0, attention.INPUTS, (1, attention.WINDOW))
    b = a.copy()
    b[0, 40:] = 7
    first, second = net.forward(a)[0], net.forward(b)[0]
    assert np.exp(first).sum(axis=2) == pytest.approx(1, abs=1e-4)
    assert first[0, :40] == pytest.approx(second[0, :40], abs=1e-5)
    ids = np.random.default_rng(2).integers(0, attention.VOCABULARY, 300)
    assert (net.class_logs(ids, np.array([0, 0, 130, 300])) < 0).all()


def test_attention_learns_from_every_window():
    rng = np.random.default_rng(3)
    lengths = [1, 64, 65, 1000]
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    ids = rng.integers(0, attention.END_ID, bounds[-1])
    ids[bounds[1:] - 1] = attention.END_ID
    windows = attention.training_windows(ids, bounds)
    assert [sum(t == i for t, _, _ in windows) for i in range(4)] == [1, 1, 2, 16]
    table, counted = attention._table([w for _, _, w in windows])
    assert (table[:, 1:][counted] == ids).all()  # every id and every end once, in order
    before = np.concatenate(([attention.END_ID], ids[:-1]))
    assert (table[:, :-1][counted] == before).all()  # after the id that stands before it, or an end


def test_attention_training_grows_with_the_corpus(spark, monkeypatch):
    monkeypatch.setattr(attention, "CELL_WINDOWS", 20)
    learned, fit = [], attention._round
    monkeypatch.setattr(attention, "_round", lambda net, windows, *a: (learned.append(windows.count()), fit(net, windows, *a))[1])
    texts = [(i, f"text {i} " + " ".join(f"w{i % 7}x{j}" for j in range(60))) for i in range(300)]
    docs = ship(spark).createDataFrame(texts, "doc_id long, text string")
    for n in (100, 300):
        learned.clear()
        model = attention.train(docs.where(f"doc_id < {n}"), vocabulary("byte_bpe_50k.json"))
        whole = attention.encoder(model.tokenizer, "byte").encode([t for _, t in texts[:n]], attention.END_ID)[1]
        assert sum(learned[1:]) == sum(-(-int(k) // attention.WINDOW) for k in np.diff(whole))
        assert all(np.isfinite(w).all() for w in model.net.w.values())


def test_toxicity_cases(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 1), (6, 0), (99, 1)], "doc_id long, toxic int")
    assert toxicity.scores(empty, toxicity.train(empty, labels)).count() == 0
    even = toxicity.train(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.scores(docs, even).collect()} == {0.5}
    rows = toxicity.scores(docs, toxicity.train(docs, labels)).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)


def test_disguised_words_are_restored(spark):
    texts = ["you idiot and moron are worthless trash", "the idiot is a clown", "an idiot said so"] * 40
    learn = ship(spark).createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    words = toxicity.Restorer(toxicity.letter_model(learn))
    for seen in ("1d10t", "i d i o t", "i.d.i.o.t", "idiooooot", "!diot", "id1ot!!"):
        assert list(words.words(f"you {seen} and")) == ["you", "idiot", "and"]
    assert list(words.words("größer 1234")) == ["größer", "1234"]


def test_spacing_doubling_and_full_leetspeak_are_decoded(spark):
    texts = ["you are a stupid person and the idiot is an ass", "a stupid idiot sat up", "the person is good", "who is a person"] * 40
    learn = ship(spark).createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    words = toxicity.Restorer(toxicity.letter_model(learn), toxicity.word_counts(learn))
    for seen, want in (
        ("you are a s t u p i d person", "you are a stupid person"),
        ("s t u p i d i d i o t", "stupid idiot"),
        ("the st up id person", "the stupid person"),
        ("the s  t  u  p  i  d person", "the stupid person"),
        ("stuupid iidioot", "stupid idiot"),
        ("an 455 is good", "an ass is good"),
        ("1 2 3 455 1234", "1 2 3 ass 1234"),
        ("größer als a good person", "größer als a good person"),
    ):
        assert " ".join(words.words(seen)) == want


def test_syncmer_cases(docs, empty):
    assert syncmers.edit_check(empty).count() == 0
    rows = syncmers.edit_check(docs).collect()
    assert len(rows) == len(ROWS)
    assert {r["fingerprint"] for r in rows if r["doc_id"] in (3, 4)} == {""}
    assert syncmers.edit_check(docs.where("doc_id = 1")).first()["near_next"] == 1.0
    text = "".join(chr(97 + i * i % 23) for i in range(5000)) + PASSAGE
    assert syncmers.likeness(syncmers.anchors(text), syncmers.anchors("xyz " + text)) > 0.9


def test_syncmers_cover_long_texts():
    rng = np.random.default_rng(4)
    text = "".join(map(chr, rng.integers(97, 123, 120_000)))
    found = syncmers.anchors(text)
    places = np.sort(found[1])
    stretch = 2 * syncmers.K - syncmers.S - 1
    assert places[0] <= stretch - syncmers.K and np.diff(places).max() <= stretch - syncmers.K + 1
    assert places[-1] >= len(text) - stretch
    passage = text[70_000:70_300]
    other = "".join(map(chr, rng.integers(97, 123, 120_000)))
    mine = syncmers.anchors(passage)
    # an excerpt, and a passage two long texts have in common
    assert syncmers.likeness(found, mine) == pytest.approx(len(mine[0]) / len(found[0]), rel=0.05)
    assert syncmers.likeness(found, syncmers.anchors(other[:500] + passage + other[500:])) > 0


def test_mixing_packing_and_files_cases(spark, docs, empty, tmp_path):
    assert mixing.mix(empty).count() == 0 and packing.pack(empty, vocabulary("word_bpe_49k.json")).count() == 0
    assert token_files.round_trip(empty, vocabulary("byte_bpe_50k.json")).count() == 0
    assert mixing.mix(docs).count() == len(ROWS)
    assert mixing.take(docs).columns == docs.columns
    packed = packing.pack(docs, vocabulary("word_bpe_49k.json"), "word")
    assert packed.where("piece = 0").count() == len(ROWS)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 4096
    assert token_files.round_trip(docs, vocabulary("byte_bpe_50k.json")).count() == len(ROWS)


def test_vector_cases(spark):
    schema = "vec_id long, embedding array<float>, label int, cid string, vec string"
    rows = [
        (1, [1.0, 0.0], 1, "", ""),
        (2, [1.0, 0.0], 1, "", ""),
        (3, [1.0, 0.1], 1, "", ""),
        (4, [1.0, 0.0], None, "", ""),
        (5, [0.0, 0.0], 1, "", ""),
        (6, None, 1, "", ""),
        (7, [1.0, None], 1, "", ""),
        (8, [float("nan"), 1.0], 1, "", ""),
        (9, [], 1, "", ""),
        (10, [1.0, 0.0], 2, "", ""),
        (None, None, None, None, None),
    ]
    frame = ship(spark).createDataFrame(rows, schema)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in cap_filters.near_vectors(frame).collect()}
    assert got == {**{i: (0, i) for i in (4, 5, 6, 7, 8, 9, 10, None)}, 1: (2, 1), 2: (2, 1), 3: (2, 1)}
    assert cap_filters.near_vectors(frame.limit(0)).count() == 0


def test_pipeline_stages_on_hard_rows(spark, docs, empty):
    for start in (docs, empty):
        frame = start
        for name, function in corpus_pipeline.STAGES:
            columns = frame.columns
            frame = function(spark, frame, "")
            if name != "pattern_packing":
                assert frame.columns == columns
        rows = frame.collect()
    assert rows == []


def test_packing_plan_ends_and_is_exact():
    rng = np.random.default_rng(0)
    lengths, times = np.unique(np.minimum(4096, rng.lognormal(6, 1.2, 1000).astype(int) + 1), return_counts=True)
    counts = dict(zip(lengths.tolist(), times.tolist()))
    used = dict.fromkeys(counts, 0)
    for repeats, members in packing.plan(counts):
        assert repeats > 0 and sum(length * n for length, n in members) <= 4096
        for length, n in members:
            used[length] += n * repeats
    assert used == counts


def test_encoder_takes_arrow_texts_as_the_tokenizer_does():
    import random

    import pyarrow as pa
    from tokenizers import Tokenizer

    from tidemark.llm import tokens
    from tidemark.llm.common import KEPT, vocabulary

    chosen = random.Random(3)
    bits = ["a", "b", "Zz", "é", " ", " ", " ", "\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", " ", "0", "'s", "<|endoftext|>", "日本", "́", "x" * 70, "\x00"]
    texts = ["".join(chosen.choice(bits) for _ in range(chosen.randrange(25))) for _ in range(1500)] + [None, "", " ", "a\nb c", "one two\nthree"]
    for name, kind in (("word_bpe_49k.json", "word"), ("byte_bpe_50k.json", "byte")):
        path = vocabulary(name)
        plain, mine = Tokenizer.from_file(path), tokens.Encoder(path, kind)
        for _ in range(2):
            ids, bounds = mine.encode(pa.array(texts, pa.string()), 7)
            for i, text in enumerate(texts):
                assert ids[bounds[i] : bounds[i + 1]].tolist() == [*plain.encode(text or "", add_special_tokens=False).ids, 7]
            mine._forget()
        assert tokens.encoder(path, kind) is tokens.encoder(path, kind)
    for drop in KEPT:
        drop()
    assert tokens.encoder.cache_info().currsize == 0


def test_stages_pass_texts_in_small_batches(spark):
    import corpus_pipeline
    from tidemark.llm.common import BATCH_ROWS

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.unset(name)
    try:
        rows = spark.createDataFrame([(1, "some text of a few words", "en", "web", 24)], "doc_id LONG, text STRING, lang STRING, source STRING, n_chars INT")
        for _, function in corpus_pipeline.STAGES[:2]:
            function(spark, rows, "").collect()
            assert int(spark.conf.get(name)) <= BATCH_ROWS
    finally:
        spark.conf.set(name, before)
