import tracemalloc
import zlib

import numpy as np
from pyspark.sql import functions as F

from rankforge.llm import language_id as L


def counts(texts):
    return np.unique(np.concatenate([L.gram_keys(L.char_codes(t)) for t in texts]), return_counts=True)


def test_char_codes():
    assert "".join(map(chr, L.char_codes("Ab, c1D!"))) == "ab c d "
    assert len(L.char_codes(None)) == len(L.char_codes("12 .")) == 0
    assert L.char_codes("\U00020000").tolist() == [0xFFFF, 32]


def test_kneser_ney_probabilities_sum_to_one():
    m = L.LanguageModels({"x": counts(["the cat sat on the mat", "a cat ate the hat"]), "y": counts(["der hund und die katze"])})
    for context in ("the", "cat", "zzz", "t h"):
        base = sum(ord(c) << 16 * (2 - i) for i, c in enumerate(context)) << 16 & (2**64 - 1)
        p = np.exp(m.log_prob(np.arange(1 << 16).astype(np.uint64) | np.uint64(base)))
        assert (p > 0).all() and np.allclose(p.sum(0), 1)


def test_hash_array_finds_all_and_nothing_else():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64))
    h = L.HashArray(keys)
    at = h.find(keys)
    assert (h.hashes[at] == L.mix64(keys)).all()
    assert (h.find(np.setdiff1d(rng.integers(0, 2**63, 5000).astype(np.uint64), keys)) == -1).all()
    assert (L.HashArray(keys[:0]).find(keys[:3]) == -1).all()


def test_held_out_accuracy_and_edge_cases(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held_out", L.held_out(F.col("doc_id")))
    models = L.fit_language_models(docs.filter("not held_out"))
    got = L.classify(docs, models).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)
    assert sum(r.rejected for r in got) <= 0.01 * len(got)

    odd = spark.createDataFrame(
        [(1, None, 1.0), (2, "", 1.0), (3, "12 !?", 1.0), (None, "the of and to in", 1.0), (None, "the of and to in", 1.0),
         (5, "xq zv jk wq " * 300, 1.0), (6, "the and of it " * 30_000, 1.0)], "doc_id long, text string, score double")
    by = {}
    for r in L.classify(odd, models).collect():
        by.setdefault(r.doc_id, []).append(r)
    for i in (1, 2, 3):
        assert by[i][0].lang_pred == "und" and by[i][0].score == 0 and by[i][0].rejected
    assert len(by[None]) == 2 and by[None][0] == by[None][1] and by[None][0].lang_pred == "en"
    assert by[5][0].rejected and not by[6][0].rejected
    assert all(0 <= r.score <= 1 for rows in by.values() for r in rows)


def test_no_training_text(spark):
    none = spark.createDataFrame([], "text string, lang string")
    models = L.fit_language_models(none)
    rows = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    assert L.classify(rows, models).first().lang_pred == "und"
    assert L.classify(rows.limit(0), models).collect() == []


def test_model_bound_keeps_the_most_frequent(spark):
    df = spark.createDataFrame([("abc " * 50 + "xyz", "q")], "text string, lang string")
    small, whole = L.fit_language_models(df, model_grams=4), L.fit_language_models(df)
    assert len(small.grams[-1].hashes) <= 4 < len(whole.grams[-1].hashes)


def test_pruning_comes_after_the_statistics():
    c = {"x": counts(["the cat sat on the mat", "a cat ate the hat"]), "y": counts(["der hund und die katze"])}
    whole, small = L.LanguageModels(c), L.LanguageModels(c, 3)
    assert 3 <= len(small.grams[-1].hashes) <= 6
    for n in range(L.ORDER - 1):  # lower orders are those of all counts
        assert (whole.grams[n].hashes == small.grams[n].hashes).all() and np.allclose(whole.prob[n], small.prob[n])
    for context in ("the", "cat", "zzz"):
        base = sum(ord(x) << 16 * (2 - i) for i, x in enumerate(context)) << 16 & (2**64 - 1)
        p = np.exp(small.log_prob(np.arange(1 << 16).astype(np.uint64) | np.uint64(base)))
        assert (p > 0).all() and np.allclose(p.sum(0), 1)
    for i, x in enumerate(small.langs):  # the fit is calibrated on all counts
        k, n = c[x]
        assert np.isclose(small.mean[i], -(small.log_prob(k)[:, i] * n).sum() / n.sum())


def test_no_language_or_type_is_left_out(spark):
    rng = np.random.default_rng(2)
    text = "".join(map(chr, rng.integers(0x4E00, 0x9FA0, 1_200_000)))  # all n-grams once, more than 2^20 types
    df = spark.createDataFrame([(text, "z"), ("the cat sat on the mat " * 9, "en")], "text string, lang string")
    models = L.fit_language_models(df)
    assert models.langs == ["en", "z"]
    assert len(models.grams[-1].hashes) > 1_190_000
    assert L.fit_language_models(df, model_grams=2).langs == ["en", "z"]
    assert models.predict([text[:200]], 4.0, 0.5)[0] == ["z"]


def naive_kneser_ney(text):
    """Probability of a character after three others, by the definition, in dictionaries."""
    from collections import Counter, defaultdict
    padded = "   " + "".join(map(chr, L.char_codes(text)))
    orders = {4: Counter(padded[i:i + 4] for i in range(len(padded) - 3))}
    for n in (3, 2, 1):
        orders[n] = Counter(g[1:] for g in orders[n + 1])
    rates, after = {}, {}
    for n, grams in orders.items():
        once, twice = (sum(c == k for c in grams.values()) for k in (1, 2))
        rates[n] = once / (once + 2 * twice) if once and twice else 0.5
        after[n] = defaultdict(list)
        for g, c in grams.items():
            after[n][g[:-1]].append(c)

    def p(gram):
        n = len(gram)
        if n == 0:
            return 1 / 65536
        seen = after[n].get(gram[:-1])
        if not seen:
            return p(gram[1:])
        c, d = orders[n].get(gram, 0), rates[n]
        return (max(c - d, 0) + d * len(seen) * p(gram[1:])) / sum(seen)
    return p


def test_against_a_naive_kneser_ney():
    train = {"x": "the cat sat on the mat and the hat of the rat", "y": "der hund und die katze und der hut"}
    m = L.LanguageModels({k: counts([t]) for k, t in train.items()})
    for text in ("the katze sat", "zz und q", "a", "der the der " * 40):
        codes = L.char_codes(text)
        padded = "   " + "".join(map(chr, codes))
        _, h = m.entropies([text])
        for i, lang in enumerate(m.langs):
            p = naive_kneser_ney(train[lang])
            want = -np.mean([np.log(p(padded[j:j + 4])) for j in range(len(codes))])
            assert np.isclose(h[0, i], want), (text, lang)


def test_calibration(spark):
    """Counts of the texts kept apart, and their temperature, usual cross-entropy and margin, by a plain version."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text", "lang")
    rows = docs.filter("text is not null and lang is not null").select("text", "lang", L.apart(F.col("text")).alias("aside")).collect()
    models = L.fit_language_models(docs)
    by = {}
    for r in rows:
        if not r.aside and len(L.char_codes(r.text)):
            by.setdefault(r.lang, []).append(r.text)
    first = L.LanguageModels({k: counts(v) for k, v in by.items()})
    kept = [r for r in rows if r.aside and len(L.char_codes(r.text))]
    sizes, h = first.entropies([r.text for r in kept])
    own = np.array([first.langs.index(r.lang) for r in kept])
    true = h[np.arange(len(kept)), own]
    for i, lang in enumerate(models.langs):
        mine = own == i
        assert np.isclose(models.mean[i], (true * sizes)[mine].sum() / sizes[mine].sum())
    gap = (h - h.min(1, keepdims=True)) * sizes[:, None]
    losses = [(np.log(np.exp(-gap * t).sum(1)) + gap[np.arange(len(kept)), own] * t).sum() for t in L.HEAT]
    assert models.heat == L.HEAT[int(np.argmin(losses))]
    beyond = np.sort(true - models.mean[own] - 4 * first.spread[own] / np.sqrt(sizes))
    assert np.isclose(models.margin, max(0.0, beyond[int(np.ceil(0.99 * len(beyond))) - 1]))
    whole = {k: counts([r.text for r in rows if r.lang == k and len(L.char_codes(r.text))]) for k in by}
    assert (models.grams[-1].hashes == L.LanguageModels(whole).grams[-1].hashes).all()


def test_all_evidence_counts():
    m = L.LanguageModels({"x": counts(["the cat sat on the mat"]), "y": counts(["the cat sat on the hat"])})
    scores = m.predict(["a mat " * k for k in (1, 10, 100, 1000)], 1e9, 0.0)[1]
    assert (np.diff(scores) >= 0).all() and scores[-1] > 0.999


def test_memory_of_scoring_does_not_follow_the_number_of_texts():
    rng = np.random.default_rng(5)
    texts = ["".join(chr(97 + c) for c in rng.integers(0, 26, 2_000)) for _ in range(240)]
    keys, n = np.unique(np.concatenate([L.gram_keys(L.char_codes(t)) for t in texts[:40]]), return_counts=True)
    models = L.LanguageModels({x: (keys, n) for x in "abcd"})
    peak = []
    for some in (texts[40:120], texts[40:]):  # texts that the models have not seen
        tracemalloc.start()
        sizes, h = models.entropies(some)
        peak.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert (sizes == 2_001).all()  # and the space at the end
        assert all(np.array_equal(models.entropies([t])[1][0], x) for t, x in zip(some[::20], h[::20]))
    assert peak[1] < 1.5 * peak[0]
