"""Language identification: held-out accuracy, calibration, plain recounts of features and frequencies, odd tables."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from parceltrail.llm import language


@pytest.fixture(scope="module")
def model(docs):
    return language.fit(docs)


def plain_grams(text):
    """Runs of one to three characters, gaps as one blank, in plain Python."""
    signs = " "
    for c in text.lower():
        if c.isalpha():
            signs += c
        elif not signs.endswith(" "):
            signs += " "
    if not signs.endswith(" "):
        signs += " "
    return Counter(signs[k : k + n] for n in (1, 2, 3) for k in range(len(signs) - n + 1))


def bucket(gram):
    h = 0
    for c in gram:
        h = (h * int(language._BASE) + ord(c) + 1) % (1 << 64)
    return int(language.mixed(np.array([h + len(gram) - 1], np.uint64))[0] >> np.uint64(64 - language.BUCKET_BITS))


TEXTS = ["The cat, the CAT!", "", "123 --", "é", " Übung  übt\n", "日本語 テスト", "a" * 5000, "x1y2", "\x00z", "İstanbul 𝔘"]


def test_histograms_against_plain_counts():
    got = dict(language.histograms(TEXTS))
    assert set(got) == {k for k, t in enumerate(TEXTS) if any(c.isalpha() for c in t)}
    for k, counts in got.items():
        want = np.zeros(language.BUCKETS, int)
        for gram, n in plain_grams(TEXTS[k]).items():
            want[bucket(gram)] += n
        assert (counts == want).all()
        assert (dict(language.histograms([TEXTS[k]]))[0] == want).all()
    assert list(language.histograms([])) == []


def held(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_frequencies_are_of_the_learning_rows(docs, model):
    rows = [r.text for r in docs.select("doc_id", "text", "lang").collect() if not held(r.doc_id) and r.lang is not None]
    seen = np.zeros(language.BUCKETS, int)
    for text in rows:
        for b in {bucket(g) for g in plain_grams(text)} if any(c.isalpha() for c in text) else ():
            seen[b] += 1
    assert np.allclose(model.idf, np.log((1 + len(rows)) / (1 + seen)) + 1)


def test_held_out_accuracy_and_calibration(docs, model):
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = [r for r in language.predict(docs, model).collect() if r.lang_pred != "und"]
    out = [r for r in got if held(r.doc_id)]
    right = [r.lang_pred == truth[r.doc_id] for r in out]
    assert len(out) > 30 and np.mean(right) > 0.95
    assert abs(np.mean([r.score for r in out]) - np.mean(right)) < 0.08
    assert (model.weights != 0).mean() < 0.5, "the elastic net leaves most weights at zero"


def test_prediction_against_a_plain_softmax(model):
    for counts in dict(language.histograms(TEXTS)).values():
        value = counts * model.idf
        logits = [(language.SPREAD * sum(value * model.weights[:, k]) / sum(value) + model.bias[k]) / model.temperature for k in range(len(model.langs))]
        shares = [math.exp(x - max(logits)) for x in logits]
        lang, score = model.predict(counts)
        assert lang == model.langs[shares.index(max(shares))] and math.isclose(score, max(shares) / sum(shares), rel_tol=1e-9)


def test_ftrl_follows_its_formula():
    """Dense and unvectorised, on a few rows."""
    dice = np.random.default_rng(1)
    rows = [(np.array([k % 3, 3]), np.array([1.0 + dice.random(), 1.0])) for k in range(12)]
    truth = np.array([k % 3 for k in range(12)])
    z, n = np.zeros((4, 3)), np.zeros((4, 3))

    def weight(z, n):
        return 0.0 if abs(z) <= language.L1 else -(z - math.copysign(language.L1, z)) / ((language.SOFT + math.sqrt(n)) / language.STEP + language.L2)

    order = np.random.default_rng(13)
    for _ in range(language.EPOCHS):
        for k in order.permutation(12).tolist():
            at, value = rows[k]
            w = {(i, c): weight(z[i, c], n[i, c]) for i in at for c in range(3)}
            logits = [sum(v * w[i, c] for i, v in zip(at, value)) for c in range(3)]
            p = [math.exp(x) / sum(map(math.exp, logits)) for x in logits]
            for i, v in zip(at, value):
                for c in range(3):
                    g = v * (p[c] - (c == truth[k]))
                    z[i, c] += g - (math.sqrt(n[i, c] + g * g) - math.sqrt(n[i, c])) / language.STEP * w[i, c]
                    n[i, c] += g * g
    want = [[weight(z[i, c], n[i, c]) for c in range(3)] for i in range(4)]
    assert np.allclose(language.ftrl(rows, truth, 4, 3), want)


def test_odd_tables(spark, odd, odd_rows, empty, model):
    rows = language.predict(odd, model).collect()
    assert len(rows) == len(odd_rows)
    by_text = {}
    for r, text in zip(rows, [r[1] for r in odd_rows]):
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text or "")) and 0 <= r.score <= 1
        assert by_text.setdefault(text, (r.lang_pred, r.score)) == (r.lang_pred, r.score)
    assert language.predict(empty, model).count() == 0
    assert language.predict(odd, language.fit(empty)).select("lang_pred", "score").distinct().collect() == [("und", 0.0)]
    one = language.fit(odd)  # one language only: every text with a letter is of it
    assert {(r.lang_pred, r.score) for r in language.predict(odd, one).collect()} == {("en", 1.0), ("und", 0.0)}
    # Neither lang, source nor held-out rows are read by the model.
    frame = odd.selectExpr("doc_id", "text", "case when doc_id is null or crc32(cast(doc_id as string)) % 4 = 2 then 'xx' else lang end as lang")
    assert language.fit(frame).langs == ("en",)


def test_sample_is_even_and_repeatable(spark):
    rows = [(k, f"some words of {k}", "big" if k % 10 else "small") for k in range(1, 3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    took = [Counter(k for k, _, _ in language.sample(frame.repartition(n), {"big": 2699, "small": 299}, 200)) for n in (1, 7)]
    assert took[0] == took[1] == {0: 100, 1: 100}
