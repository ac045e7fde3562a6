"""Figures of the training rows of every fold against a refit on them."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tamarack.operators import models, training


def frame(seed, n=400, folds=4):
    draw = np.random.default_rng(seed)
    x = np.where(draw.random(n) < 0.34, 5.0, np.round(draw.lognormal(0, 2, n), 2))
    made = pd.DataFrame({
        "fold": draw.integers(0, folds, n), "x": x, "y": draw.normal(1e6, 1, n), "z": np.nan, "flat": 7.0,
        "c": draw.choice(["a", "b", "b'\\", None], n), "label": draw.choice(["p", "q"], n, p=[0.9, 0.1]),
    })
    made.loc[draw.random(n) < 0.2, "x"] = np.nan
    made.loc[n // 2:, "c"] = made.c[n // 2:].where((made.fold != 1) | (made.c != "a"), "only here")
    return made


def refit(rows, columns):
    numeric = {}
    for c in columns:
        median = rows[c].median() if rows[c].notna().any() else 0.0
        filled = rows[c].fillna(median)
        numeric[c] = (median, filled.mean(), filled.std(ddof=0) or 1.0)
    counts = rows.c.dropna().value_counts()
    return numeric, sorted(counts.index), min(counts.index, key=lambda k: (-counts[k], k)), rows.label.value_counts().to_dict()


@pytest.mark.parametrize("accuracy", [20, 20_000])
def test_every_fold_like_a_refit(spark, accuracy):
    rows, columns = frame(3), ["x", "y", "z", "flat"]
    rows.loc[:30, "fold"] = -1  # on the training side of every fold
    rows.loc[:30, "x"] += 1000
    given = spark.createDataFrame(rows.astype(object).where(rows.notna() | (rows.columns == "x"), None), "fold int, x double, y double, z double, flat double, c string, label string").repartition(5)
    found = training.figures_without(given, "fold", [0, 1, 2, 3], columns, "c", "label", accuracy)
    for fold, figures in found.items():
        numeric, categories, mode, labels = refit(rows[rows.fold != fold], columns)
        assert (figures.categories, figures.mode, figures.labels) == (categories, mode, labels)
        for c in columns:
            assert figures.numeric[c][0] == numeric[c][0]
            np.testing.assert_allclose(figures.numeric[c], numeric[c], rtol=1e-9, err_msg=c)
    assert "only here" not in found[1].categories


def test_all_rows_and_none(spark):
    rows = spark.createDataFrame([(1.0, "a"), (4.0, None), (None, "a")], "x double, c string")
    figures = training.figures_of(rows, ["x"], "c")
    assert figures.numeric["x"] == pytest.approx((2.5, 2.5, np.std([1, 4, 2.5])))
    assert (figures.categories, figures.mode, figures.rows) == (["a"], "a", 3)
    nothing = training.figures_of(rows.limit(0), ["x"], "c")
    assert (nothing.numeric, nothing.categories, nothing.mode, nothing.rows) == ({"x": (0.0, 0.0, 1.0)}, [], None, 0)
    missing = training.figures_of(rows.withColumn("x", F.lit(None).cast("double")), ["x"], "c")
    assert missing.numeric["x"] == (0.0, 0.0, 1.0)


def test_slope_of_the_logistic_loss(spark):
    """Against numerical derivatives, away from the optimum and at it."""
    draw = np.random.default_rng(7)
    x, y, w = draw.normal(size=(60, 2)), draw.integers(0, 3, 60), draw.random(60) + 0.5
    x[:, 0] += y
    rows = spark.createDataFrame([(Vectors.dense(a), float(b), float(c)) for a, b, c in zip(x, y, w)], ["features", "_class", "_weight"])
    ones = np.column_stack([x, np.ones(60)])
    for steps in (2, 2000):
        estimator = models.logistic_regression(20, steps)
        model = estimator.fit(rows)
        beta = np.column_stack([model.coefficientMatrix.toArray(), model.interceptVector.toArray()])

        def loss(beta):
            z = ones @ beta.T
            return (w * (np.log(np.exp(z).sum(1)) - z[np.arange(60), y])).sum() / w.sum() + 0.5 / 20 * (beta[:, :2] ** 2).sum()

        found = {(r["class"], r.feature): r.gradient for r in models.logistic_gradient(model, rows, ["a", "b", "c"], ["f", "g"]).collect()}
        for k, c in enumerate("abc"):
            for j, f in enumerate(["f", "g", "intercept"]):
                step = np.zeros((3, 3))
                step[k, j] = 1e-5
                assert found[c, f] == pytest.approx((loss(beta + step) - loss(beta - step)) / 2e-5, abs=1e-8)
        assert (max(map(abs, found.values())) < 1e-6) == (steps == 2000)


def test_jobs_do_not_grow_with_the_folds(spark):
    given = spark.createDataFrame(frame(5, folds=8).drop(columns="z"))
    jobs = []
    for folds in (2, 8):
        seen = len(jobs_of(spark, lambda: training.figures_without(given, "fold", list(range(folds)), ["x", "y"], "c", "label")))
        jobs.append(seen)
    assert jobs[0] == jobs[1] <= 8


def jobs_of(spark, work):
    spark.sparkContext.setJobGroup("figures", "figures")
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup("figures"))
    work()
    return set(spark.sparkContext.statusTracker().getJobIdsForGroup("figures")) - before
