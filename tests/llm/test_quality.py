import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamarack.llm import quality
from tamarack.llm.queries import op7_quality_classifier, ratings


def test_thresholds_are_ordered_and_tails_fall():
    draw = np.random.default_rng(0)
    grades = draw.integers(0, 4, 400)
    texts = [" ".join(["abcd"[g]] * 3 + [f"n{draw.integers(50)}" for _ in range(10)]) for g in grades]
    model = quality.trained(texts, grades, quality.Setting(bits=12, grades=4))
    assert (np.diff(model.thresholds) > 0).all()
    tails = model.tails(texts)
    assert (np.diff(tails, axis=1) <= 0).all()
    expected = tails.sum(axis=1)
    assert np.corrcoef(expected, grades)[0, 1] > 0.9
    assert [round(expected[grades == g].mean()) for g in range(4)] == [0, 1, 2, 3]


def tails_word_by_word(model, text):
    """The docstring's means, one word and one triple at a time, in Python's own numbers."""
    mask, size = (1 << 64) - 1, 1 << model.how.bits

    def mixed(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ x >> 27) * 0x94D049BB133111EB & mask
        return x ^ x >> 31

    base, raw = 0x9E3779B97F4A7C15, (text or "").encode()
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").lower().encode())
    of_words = [mixed(sum((b + 1) * pow(base, k, 1 << 64) for k, b in enumerate(w)) & mask) % size for w in words]
    of_triples = [mixed(raw[i] | raw[i + 1] << 8 | raw[i + 2] << 16) % size for i in range(len(raw) - 2)]
    again = [0 if i == 0 else 1 + (words[i] == words[i - 1]) for i in range(len(words))]
    score = sum(sum(float(weights[s]) for s in slots) / max(len(slots), 1) for weights, slots in zip(model.weights, (of_words, of_triples, again)))
    return [1 / (1 + math.exp(t - score)) for t in model.thresholds]


def test_query_is_brute_force(spark, sf):
    """Every row of the query from the fitted model, word by word."""
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    held = {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    model = quality.fit(spark.read.parquet(f"{sf}/documents.parquet"), ratings(labels.where(~F.col("doc_id").isin(list(held)))))
    got = {r.doc_id: r for r in op7_quality_classifier(spark, sf).collect()}
    assert len(got) == len(rows)
    for r in rows:
        tails = tails_word_by_word(model, r.text)
        assert got[r.doc_id].expected_grade == pytest.approx(sum(tails), abs=1e-5)
        assert got[r.doc_id].p_good == pytest.approx(tails[0], abs=1e-5)
        assert (got[r.doc_id].held_out, got[r.doc_id].kept) == (r.doc_id in held, got[r.doc_id].p_good >= 0.5)


def test_a_fit_is_better_than_its_neighbours():
    """The log likelihood of the rated texts falls when all weights shrink or grow, or a threshold moves."""
    draw = np.random.default_rng(3)
    grades = draw.integers(0, 3, 300)
    texts = [" ".join(["abc"[g if draw.random() < 0.8 else draw.integers(3)]] * 2 + [f"n{draw.integers(20)}" for _ in range(6)]) for g in grades]
    model = quality.trained(texts, grades, quality.Setting(bits=12, updates=6000))

    def likelihood(weights, thresholds):
        tails = quality.Model(weights, thresholds, model.how).tails(texts)
        whole = np.concatenate([np.ones((len(texts), 1)), tails, np.zeros((len(texts), 1))], axis=1)
        each = np.arange(len(texts))
        return np.log(whole[each, grades] - whole[each, grades + 1]).sum()

    best = likelihood(model.weights, model.thresholds)
    for step in ([0.5, 0], [-0.5, 0], [0, 0.5], [0, -0.5]):
        assert likelihood(model.weights, model.thresholds + np.array(step)) < best
    assert likelihood(model.weights * 0.5, model.thresholds) < best
    assert likelihood(model.weights, np.zeros(2)) < best


def test_a_score_does_not_depend_on_the_batch():
    draw = np.random.default_rng(1)
    texts = ["alpha beta " * 5, "", None, "Gamma gamma " * 9, "x", "zeta " * 300_000]
    model = quality.Model(draw.normal(size=(quality.KINDS, 1 << 12)).astype(np.float32), np.array([-0.5, 0.5]), quality.Setting(bits=12))
    assert np.allclose(model.tails(texts), np.concatenate([model.tails([t]) for t in texts]), atol=1e-6)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    got = op7_quality_classifier(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").select("kept", "quality").toPandas()
    assert got.loc[got["quality"] == 1, "kept"].mean() >= 0.98
    assert got.loc[got["quality"] == 0, "kept"].mean() <= 0.25


def test_odd_rows_and_few_ratings(spark, documents):
    df = documents([(1, None), (2, ""), (3, "some words"), (None, "some words"), (3, "some words")]).withColumn("_tail", F.lit("clash"))
    none = spark.createDataFrame([], "doc_id long, grade int")
    one = spark.createDataFrame([(3, 2), (3, None), (None, 1)], "doc_id long, grade int")
    for ratings, grade in ((none, 0), (one, 2)):
        got = quality.graded(df, quality.fit(df, ratings))
        assert [round(r._grade) for r in got.collect()] == [grade] * 5
        assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "_grade", "_tail", "_kept"]
