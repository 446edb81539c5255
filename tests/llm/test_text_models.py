"""Language field, quality classifier, language model: against brute force, and held-out accuracy."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sensorloom.llm import language_id, lm, quality
from sensorloom.llm.common import WordIds, split_number, table
from sensorloom.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"
WORD_BPE = "word_bpe_49k.json"


def chain_posteriors(scores, start, moves):
    """Posteriors by summing over all label rows."""
    n, L = scores.shape
    post, total = np.zeros((n, L)), 0.0
    for labels in product(range(L), repeat=n):
        w = math.exp(start[labels[0]] + sum(scores[i, k] for i, k in enumerate(labels)) + sum(moves[a, b] for a, b in zip(labels, labels[1:])))
        total += w
        for i, k in enumerate(labels):
            post[i, k] += w
    return post / total


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 0, 5, 1, 4])
    scores, start, moves = rng.normal(size=(13, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    parts = [scores[e - n : e] for e, n in zip(np.cumsum(lengths), lengths)]
    expected = [chain_posteriors(p, start, moves) if len(p) else np.zeros((0, 3)) for p in parts]
    some = lengths[lengths > 0]
    assert np.allclose(language_id.forward_backward(scores, some, start, moves)[0], np.concatenate(expected))
    for block in (1, 2, 64):
        assert np.allclose(language_id.posteriors(scores, lengths, start, moves, block), [e.sum(axis=0) for e in expected])


def test_blocks_equal_one_long_chain():
    rng = np.random.default_rng(1)
    lengths = np.array([700, 1, 64, 65, 128])
    scores, start, moves = rng.normal(size=(lengths.sum(), 4)) * 3, rng.normal(size=4), rng.normal(size=(4, 4))
    whole, _ = language_id.forward_backward(scores, lengths, start, moves)
    assert np.allclose(language_id.posteriors(scores, lengths, start, moves), np.add.reduceat(whole, np.cumsum(lengths) - lengths))


def test_language_of_switched_text_and_odd_rows(spark):
    docs = table(spark, SF, "documents")
    model = language_id.fit(docs, split_number("doc_id", 4) != 2)
    found = language_id.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(split_number("doc_id", 4) == 2).collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found)
    by = {lang: docs.where(F.col("lang") == lang).orderBy(F.desc("n_chars")).first().text[:600] for lang in ("en", "de")}
    rows = [(1, None, "x"), (2, "", "x"), (3, "12 34 !?", "x"), (4, by["en"] + " " + by["en"] + " " + by["de"], "x"), (4, by["de"], "x"), (None, by["de"], "x"), (5, by["de"] * 200, "x")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    got = sorted(((r.doc_id, r.lang_pred, r.score) for r in language_id.predict(odd, model).collect()), key=str)
    assert [g[1] for g in got if g[0] in (1, 2, 3)] == ["und"] * 3 and {g[1] for g in got if g[0] == 4} == {"en", "de"}
    assert [g[1] for g in got if g[0] is None or g[0] == 5] == ["de", "de"] and all(0 <= g[2] <= 1 for g in got)
    assert 0.5 < next(g[2] for g in got if g[0] == 4 and g[1] == "en") < 0.9
    extra = language_id.annotate(odd.withColumn("a.b", F.lit(1)), model)
    assert extra.columns[:4] == ["doc_id", "text", "lang_pred", "a.b"] and extra.count() == 7
    assert language_id.predict(odd.limit(0), model).count() == 0
    empty = language_id.fit(docs.limit(0), split_number("doc_id", 4) != 2)
    assert {r.lang_pred for r in language_id.predict(odd, empty).collect()} <= {"und"}


def test_language_of_a_long_run_that_changes_in_the_middle(spark):
    rng = np.random.default_rng(4)
    letters = {"aa": "あいうえおかきくけこさしすせそ", "bb": "たちつてとなにぬねのはひふへほ"}

    def run(lang, n):
        return "".join(rng.choice(list(letters[lang]), n))

    docs = spark.createDataFrame([(i, run(lang, 120), lang) for i, lang in enumerate(["aa", "bb"] * 60)], "doc_id long, text string, lang string")
    model = language_id.fit(docs, F.lit(True))
    texts = [(1, run("aa", 30) + run("bb", 300) + run("aa", 30)), (2, run("bb", 30) + run("aa", 300) + run("bb", 30)), (3, run("aa", 200) + run("bb", 100))]
    got = {r.doc_id: r for r in language_id.predict(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["bb", "aa", "aa"]
    assert abs(got[1].score - 5 / 6) < 0.1 and abs(got[3].score - 2 / 3) < 0.1


def test_rare_language_is_learned_among_many_rows(spark):
    rng = np.random.default_rng(6)
    letters = {"aa": "abcdefgh", "bb": "ijklmnop", "cc": "abijqrst"}
    words = {lang: ["".join(rng.choice(list(x), 5)) for _ in range(40)] for lang, x in letters.items()}

    def text(lang, n=12):
        return " ".join(rng.choice(words[lang], n))

    rows = [(i, text("cc" if i % 1500 == 7 else "ab"[i % 2] * 2), "cc" if i % 1500 == 7 else "ab"[i % 2] * 2) for i in range(12_000)]
    seen, train = [], language_id.train
    language_id.train = lambda texts, labels, langs, lexicon: seen.append(Counter(labels)) or train(texts, labels, langs, lexicon)
    try:
        model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), sample=60)
    finally:
        language_id.train = train
    assert seen[0][2] == 8 and max(seen[0].values()) < 600
    found = language_id.predict(spark.createDataFrame([(i, text("cc")) for i in range(50)], "doc_id long, text string"), model).collect()
    assert sum(r.lang_pred == "cc" for r in found) >= 45


def test_runs_are_drawn_over_the_whole_text():
    texts = [b"common " * 500 + b"left " * 600, b"common " * 500 + b"right " * 600] * 20
    model = language_id.train(texts, [0, 1] * 20, ["a", "b"], np.zeros((language_id.LEXICON, 2)))
    scores = model.emissions([b"left", b"right"])
    assert scores[0, 0] > scores[0, 1] + 1 and scores[1, 1] > scores[1, 0] + 1


@pytest.mark.parametrize("run", ["x" * 25, "abcdefghijklmnopqrstuvwxyzabc", "あいうえおかきくけ", "𐌰𐌱𐌲𐌳𐌴𐌵𐌶"])
def test_units_hold_all_letters_of_a_run(run):
    units = [u.decode().strip("\x03") for u in language_id.word_bytes(run.encode())]
    assert {run[i : i + 4] for i in range(len(run) - 3)} == {u[i : i + 4] for u in units for i in range(len(u) - 3)}
    assert all(len(u) <= language_id.LONGEST + 2 for u in language_id.word_bytes(run.encode()))


def indicators_by_hand(text: bytes) -> set:
    """The n-grams themselves, not hashed."""
    out = {text[i : i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1)}
    words = text.split()
    out |= {(n, *words[i : i + n]) for n in (1, 2) for i in range(len(words) - n + 1)}
    shapes = [(frozenset(quality.KIND[c] for c in w), quality.KIND[w[0]], quality.KIND[w[-1]], i > 0 and words[i - 1] == w) for i, w in enumerate(words)]
    return out | {("shape", *shapes[i : i + n]) for n in (1, 2, 3) for i in range(len(shapes) - n + 1)}


@pytest.mark.parametrize("text", ["", "a", " ", "Ab ab Ab!! 12 é", "x x x\ty\n", "A,b c-d  e"])
def test_indicators_are_the_distinct_ngrams(text):
    seen = np.zeros(quality.BUCKETS, bool)
    got, expected = quality.indicators(text.encode(), seen), indicators_by_hand(text.encode())
    assert len(expected) - 2 <= len(got) <= len(expected) and not seen.any() and (np.diff(got) > 0).all()


def test_dual_coordinate_descent_reaches_the_primal_optimum():
    rng = np.random.default_rng(2)
    rows = [np.sort(rng.choice(12, 4, replace=False)) for _ in range(40)]
    ratio, y = rng.normal(size=12), np.where([0 in r or 5 in r for r in rows], 1, -1)
    w, bias = quality.dual_coordinate_descent(rows, ratio, y, passes=2000)
    X = np.zeros((40, 13))
    for i, r in enumerate(rows):
        X[i, r], X[i, 12] = ratio[r], 1
        X[i] /= np.sqrt((ratio[r] ** 2).sum() + 1)
    cost = np.where(y > 0, 40 / (2 * (y > 0).sum()), 40 / (2 * (y < 0).sum()))

    def loss(v):
        return 0.5 * v @ v + (cost * np.maximum(0, 1 - y * (X @ v)) ** 2).sum()

    at = np.append(w, bias)
    assert all(loss(at) <= loss(at + rng.normal(size=13) * s) + 1e-6 for s in (1e-3, 1e-2, 0.1) for _ in range(20))


def test_quality_held_out_and_odd_rows(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    model = quality.fit(docs.withColumn("label", F.lit("clash")), labels, quality.training_rows())
    found = quality.predict(docs, model).join(labels, "doc_id").where(split_number("doc_id", 5) == 0).collect()
    assert sum((r.score >= 0.3) == (r.quality == 1) for r in found) >= 0.95 * len(found)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "a " * 50_000), (4, "b"), (4, "b"), (None, "c")], "doc_id long, text string")
    got = {(r.doc_id, r.score) for r in quality.predict(odd, model).collect()}
    assert len(got) == 5 and {s for i, s in got if i in (1, 2)} == {next(s for i, s in got if i == 1)} and all(0 <= s <= 1 for _, s in got)
    assert quality.predict(odd.limit(0), model).count() == 0
    none = quality.fit(docs, labels.limit(0), quality.training_rows())
    assert quality.predict(odd, none).count() == 6


def test_quality_weights_are_fitted_in_a_task(spark):
    """The drawn texts and their marks never reach the driver."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    seen, descend = [], quality.dual_coordinate_descent
    quality.dual_coordinate_descent = lambda *x, **options: seen.append(x) or descend(*x, **options)
    try:
        model = quality.fit(docs, labels, quality.training_rows(), sample=40)
    finally:
        quality.dual_coordinate_descent = descend
    assert not seen and model.weights.any()


@pytest.fixture(scope="module")
def encoder():
    return WordIds(vocabulary(WORD_BPE), limit=50)


@pytest.mark.parametrize("text", ["", " ", "The the, (the) don't 's it's.", "á é. x… y….", "<|endoftext|> z <|ENDOFTEXT|>", "ÜBERİ. ΑΣ.", "a\x1cb c 1.2.3!", "日本 x" * 30])
def test_word_ids_equal_the_tokenizer(encoder, text):
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    flat, counts = encoder.encode([text.encode(), b"", text.encode()])
    assert flat.tolist() == whole * 2 and counts.tolist() == [len(whole), 0, len(whole)]


def small_model(end=7):
    m = lm.Model(end)
    rng = np.random.default_rng(4)
    m.classes = 3
    m.class_of, m.member_row, m.guess_row = np.array([0, 1, 2, 0, 1, 2, 0, 1]), np.arange(8), np.arange(9)
    m.guess, m.member = rng.normal(size=(9, 3)).astype(np.float32), rng.normal(size=(8, 3)).astype(np.float32)
    m.emb = rng.normal(size=(9, lm.WIDTH)).astype(np.float32)
    m.emb[-1] = 0
    m.wq, m.wk, m.wv = (rng.normal(0, 0.2, (lm.WIDTH, lm.WIDTH)).astype(np.float32) for _ in range(3))
    m.wo, m.near = rng.normal(size=(lm.WIDTH, 3)).astype(np.float32), rng.normal(size=lm.OVERLAP + lm.STRIDE).astype(np.float32)
    m.tables()
    return m


def test_windows_score_each_token_once_as_one_by_one():
    m, rng = small_model(), np.random.default_rng(5)
    texts = [rng.integers(0, 7, n) for n in (0, 1, 31, 32, 75)]
    inputs, targets, real, text = lm.windows(np.concatenate(texts), np.array([len(t) for t in texts]), 7)
    assert np.bincount(text, real.sum(axis=1)).tolist() == [len(t) + 1 for t in texts]
    got = np.bincount(text, (m.log_probability(inputs, targets) * real).sum(axis=1))
    for t, ids in enumerate(texts):
        x, y, total = [7, *ids], [*ids, 7], 0.0
        for i in range(len(x)):
            first = max(0, i // lm.STRIDE * lm.STRIDE - lm.OVERLAP)
            w = np.array([math.exp(m.q[x[i]] @ m.k[x[j]] + m.near[i - j]) for j in range(first, i + 1)])
            out = (w[:, None] * np.array([m.v[x[j], :-1] for j in range(first, i + 1)])).sum(axis=0) / w.sum()
            logits = out @ m.wo + m.guess[x[i]]
            total += logits[m.class_of[y[i]]] - np.log(np.exp(logits).sum()) + m.member[y[i], m.class_of[x[i]]]
        assert abs(total - got[t]) < 1e-3


def test_training_lowers_the_loss():
    m, rng = small_model(), np.random.default_rng(6)
    ids = np.tile([0, 1, 2, 3, 4, 5], 60)
    inputs, targets, real, _ = lm.windows(ids, np.array([len(ids)]), 7)
    before = (m.log_probability(inputs, targets) * real).sum()
    lm.train(m, inputs, targets, real, steps=80)
    assert (m.log_probability(inputs, targets) * real).sum() > before + 50


def grouped_model(end=7):
    """Six classes in two groups; ids 0 to 5 are a class each, 6 and the end share those of 0 and 1."""
    m, rng = small_model(end), np.random.default_rng(8)
    m.classes, m.groups = 6, 2
    m.class_of = np.arange(8) % 6
    m.guess, m.member = rng.normal(size=(9, 6)).astype(np.float32), np.zeros((8, 6), np.float32)
    m.member[[0, 6]], m.member[[1, 7]] = np.log(np.float32(0.25)), np.log(np.float32(0.5))
    m.member[6] = np.log(np.float32(0.75))
    m.wo, m.wg = rng.normal(size=(lm.WIDTH, 6)).astype(np.float32), rng.normal(size=(lm.WIDTH, 2)).astype(np.float32)
    m.tables()
    return m


def test_chances_of_groups_and_classes_sum_to_one():
    m, rng = grouped_model(), np.random.default_rng(5)
    inputs, targets, real, _ = lm.windows(rng.integers(0, 7, 75), np.array([75]), 7)
    total = sum(np.exp(m.log_probability(inputs, np.full(targets.shape, y))) for y in range(8))
    assert np.allclose(total[real], 1, atol=1e-4)
    # without a say of the tokens before the last one, the two levels give the first guess as it is
    m.wo[:], m.wg[:] = 0, 0
    share = np.exp(m.guess) / np.exp(m.guess).sum(axis=1, keepdims=True)
    got = np.exp(m.log_probability(inputs, targets))
    want = share[inputs[:, lm.OVERLAP :], m.class_of[targets]] * np.exp(m.member[targets, 0])
    assert np.allclose(got[real], want[real], atol=1e-5)


def test_training_lowers_the_loss_of_groups():
    m, rng = grouped_model(), np.random.default_rng(6)
    ids = np.tile([0, 1, 2, 3, 4, 5], 60)
    inputs, targets, real, _ = lm.windows(ids, np.array([len(ids)]), 7)
    before, weights = (m.log_probability(inputs, targets) * real).sum(), m.wg.copy()
    lm.train(m, inputs, targets, real, steps=80)
    assert (m.log_probability(inputs, targets) * real).sum() > before + 50 and (m.wg != weights).all()


def test_like_rows_stand_in_one_part():
    rows = np.random.default_rng(2).permutation(np.repeat(np.arange(4), 3))
    order = lm.alike(np.eye(4)[rows] + 0.01, 4)
    assert sorted(order) == list(range(12)) and all(len(set(rows[part])) == 1 for part in order.reshape(4, 3))


def test_words_are_encoded_once_and_texts_take_their_ids(spark, encoder):
    """The ids of a word come with its counts to each chunk, and scoring encodes nothing but texts that may hold a special token."""
    odd = ["The the, x...", "a\x1cb <|endoftext|> The <|ENDOFTEXT|>", "ÜBERİ. 日本 x", "", None, " "]
    docs = table(spark, SF, "documents").select("doc_id", "text").union(spark.createDataFrame([(900_000 + i, x) for i, x in enumerate(odd)], "doc_id long, text string"))
    rows, texts = lm.chunked(docs, F.lit(True), "doc_id", "text")
    rows = rows.withColumn("chunk", (F.col("doc_id") % 3).cast("int"))
    words = lm.written(lm.with_ids(lm.counted_words(rows), vocabulary(WORD_BPE)))
    found = words.toArrow()
    flat, counts = lm.ids_of(found.column("ids").combine_chunks())
    want, want_counts = encoder.encode(found.column("word").to_pylist())
    assert flat.tolist() == want.tolist() and counts.tolist() == want_counts.tolist()
    leads = Counter(w for w, first in zip(found.column("word").to_pylist(), found.column("leads").to_pylist()) if first)
    assert set(leads) == set(found.column("word").to_pylist()) and set(leads.values()) == {1}

    model = lm.fit(*lm.chunked(docs, F.lit(True), "doc_id", "text")[:1], words, texts, vocabulary(WORD_BPE))
    got = {r.doc_id: r.score for r in lm.score_texts(docs, F.lit(True), vocabulary(WORD_BPE)).collect()}
    for r in docs.where("doc_id >= 900000 or doc_id % 9 = 0").collect():
        ids, n = encoder.encode([(r.text or "").encode()])
        inputs, targets, real, _ = lm.windows(ids.astype(np.int64), n, model.end)
        assert math.isclose((model.log_probability(inputs, targets) * real).sum() / math.log(10), got[r.doc_id], rel_tol=1e-3, abs_tol=1e-3)


def test_slices_of_id_columns():
    ids = pa.array([np.array(x, np.uint16).tobytes() for x in ([1, 2], [], [49151], [3, 4, 5])], pa.binary())
    for column, flat, counts in ((ids, [1, 2, 49151, 3, 4, 5], [2, 0, 1, 3]), (ids[1:3], [49151], [0, 1]), (ids[3:].cast(pa.large_binary()), [3, 4, 5], [3]), (ids[:0], [], [])):
        got = lm.ids_of(column)
        assert got[0].tolist() == flat and got[1].tolist() == counts


def test_language_model_base_score_and_odd_rows(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    odd = spark.createDataFrame([(100001, None), (100002, ""), (100003, "<|endoftext|> The The"), (100003, "<|endoftext|> The The"), (None, "zzz"), (100004, "of " * 30_000)],
                                "doc_id long, text string")
    rows = [(r.doc_id, r.text or "") for r in docs.union(odd).collect()]
    found = lm.score_texts(docs.union(odd), split_number("doc_id", 7) != 2, vocabulary(WORD_BPE)).collect()
    train = [zlib.crc32(str(i).encode()) % 7 != 2 if i is not None else True for i, _ in rows]
    words = [t.encode().lower().split() for _, t in rows]
    counts = Counter(w for ws, use in zip(words, train) if use for w in ws)
    counts["an end"] = sum(train)
    total, kinds = sum(counts.values()), len(counts)
    expected = Counter()
    for (i, _), ws, use in zip(rows, words, train):
        c = [counts[w] for w in ws] + [counts["an end"]]
        expected[i, use, len(c), sum(x > 0 for x in c), total, round(sum(math.log10((x + 1) / (total + kinds + 1)) for x in c), 5)] += 1
    assert Counter((r.doc_id, r.training, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found) == expected
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    same = [r.score for r in found if r.doc_id in (100001, 100002)]
    assert same[0] == same[1]
    assert lm.score_texts(odd.limit(0), split_number("doc_id", 7) != 2, vocabulary(WORD_BPE)).count() == 0
    assert lm.score_texts(odd, F.lit(False), vocabulary(WORD_BPE)).count() == 6


def test_attention_is_trained_in_a_task(spark):
    """The drawn texts never reach the driver; the weights do."""
    docs = table(spark, SF, "documents").select("doc_id", "text").limit(60)
    rows, texts = lm.chunked(docs, F.lit(True), "doc_id", "text")
    seen, train = [], lm.train
    lm.train = lambda *x, **options: seen.append(x) or train(*x, **options)
    try:
        model = lm.fit(rows, lm.written(lm.counted_words(rows)), texts, vocabulary(WORD_BPE), sample=20)
    finally:
        lm.train = train
    assert not seen and model.wo.any() and np.allclose(model.q, model.emb @ model.wq * np.minimum(1, 6 / np.maximum(np.linalg.norm(model.emb @ model.wq, axis=1, keepdims=True), 1e-6)))


def test_attention_learns_from_every_training_row(spark, encoder):
    """Ids move with the texts that hold them, drawn for the start or not; held-out texts move none, and the deal of chunks to tasks is of no account."""
    docs = table(spark, SF, "documents").select("doc_id", "text").limit(60)
    rows, texts = lm.chunked(docs, split_number("doc_id", 7) != 2, "doc_id", "text")
    rows = rows.withColumn("chunk", (F.col("doc_id") % 3).cast("int"))
    words = lm.written(lm.with_ids(lm.counted_words(rows), vocabulary(WORD_BPE)))
    coded = lm.written(lm.coded_texts(rows, words, texts, 1, 1, vocabulary(WORD_BPE)))
    model = lm.fit(rows, words, texts, vocabulary(WORD_BPE), sample=4, coded=coded.repartition(2, "chunk").sortWithinPartitions("chunk"))
    plain = lm.fit(rows, words, texts, vocabulary(WORD_BPE), sample=4)
    assert all(np.allclose(getattr(model, n), getattr(plain, n), atol=1e-5) for n in lm.weights(model))
    moved = (model.emb != np.random.default_rng(11).normal(0, 0.3, model.emb.shape).astype(np.float32)).any(axis=1)
    trained, held = (np.unique(encoder.encode([r.text for r in rows.where(use).collect()])[0]) for use in ("training", "not training"))
    assert moved[trained].all() and len(np.setdiff1d(held, trained)) and not moved[np.setdiff1d(held, trained)].any()


def test_class_chances_sum_to_one(spark):
    pairs = spark.createDataFrame([(-1, 5, 10), (5, 6, 4), (6, -1, 4), (5, -1, 6), (-1, 9, 3), (9, -1, 3)], "a int, b int, n long")
    m = lm.from_counts(pairs, 4, 600)
    share = np.exp(m.member[m.member_row].astype(float))
    for k in range(m.classes):
        members = m.class_of == k
        if members.any():
            assert np.allclose(share[members].sum(axis=0), 1, atol=1e-3)


def test_labels_that_are_held_out_change_no_score(spark):
    """Neither held-out labels nor labels of rows that are not there reach the sample shares, the counts or the calibration."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    held = split_number("doc_id", 5) == 0
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    more = labels.where(~held).union(spark.createDataFrame([(10_000_000 + i, 1, 0) for i in range(300)], labels.schema))
    made = [quality.fit(docs, x, quality.training_rows(), sample=40) for x in (labels, flipped, labels.where(~held), more)]
    scores = [{r.doc_id: r.score for r in quality.predict(docs, m).collect()} for m in made]
    assert all(np.isclose(m.shift, made[0].shift) and np.isclose(m.slope, made[0].slope) for m in made)
    assert all(np.isclose(s[i], scores[0][i], atol=1e-6) for s in scores[1:] for i in s)
