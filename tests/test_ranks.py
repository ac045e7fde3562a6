import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tamarack import session
from tamarack.functions.student import correlation_p
from tamarack.operators import association, quantiles, ranks


def skewed(seed=1, n=600):
    draw = np.random.default_rng(seed)
    values = np.where(draw.random(n) < 0.34, 5.0, np.round(draw.lognormal(0, 3, n), 3))
    frame = pd.DataFrame({"g": draw.choice(["a", "b"], n, p=[0.9, 0.1]), "v": values})
    frame.loc[draw.random(n) < 0.05, "v"] = np.nan
    return frame


@pytest.mark.parametrize("buckets", [2, 16, 256])
def test_average_ranks_like_pandas(spark, buckets):
    frame = skewed()
    found = {r.value: r.avg_rank for r in ranks.average_ranks(spark.createDataFrame(frame).repartition(5), "v", buckets=buckets).collect()}
    expected = frame.v.rank(method="average")
    assert found == dict(zip(frame.v[frame.v.notna()], expected[frame.v.notna()]))


@pytest.mark.parametrize("accuracy", [10, 100, quantiles.ACCURACY])
def test_quantiles_by_group_like_pandas(spark, accuracy):
    """Rough sketches give wide windows and the same quantiles."""
    frame = skewed(2, 6000)
    frame.loc[:1, "g"], frame.loc[2, "g"] = "two", "one"
    frame.loc[:2, "v"] = [1.0, 2.0, 3.0]
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    found = quantiles.exact_quantiles(spark.createDataFrame(frame).repartition(5), "v", shares, ["g"], accuracy).collect()
    expected = frame.groupby("g").v.quantile(shares)
    assert {r.g for r in found} == {"a", "b", "one", "two"}
    for row in found:
        np.testing.assert_allclose(row.q, expected[row.g].to_numpy(), rtol=1e-12)


def test_medians_leave_out_empty_columns(spark):
    rows = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, None), (8.0, None), (None, None)], "a double, b double")
    assert {r.column: r["median"] for r in quantiles.exact_medians(rows, ["a", "b"]).collect()} == {"a": 3.0}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sizes=st.lists(st.integers(1, 60), min_size=1, max_size=4), folds=st.integers(2, 6), digits=st.integers(1, 3))
def test_folds_are_a_balanced_partition(spark, sizes, folds, digits):
    rows = [(i, f"c{c}") for c, size in enumerate(sizes) for i in range(c * 1000, c * 1000 + size)]
    found = ranks.stratified_folds(spark.createDataFrame(rows, "id bigint, label string"), "id", "label", folds, digits=digits).toPandas()
    assert sorted(found["id"]) == sorted(r[0] for r in rows) and found["fold"].between(0, folds - 1).all()
    for _, part in found.groupby("label"):
        counts = part["fold"].value_counts().reindex(range(folds), fill_value=0)
        assert counts.max() - counts.min() <= 1


def test_folds_do_not_depend_on_row_order(spark):
    rows = spark.range(200).withColumn("label", F.when(F.col("id") % 3 == 0, "a").otherwise("b"))
    one = {r.id: r.fold for r in ranks.stratified_folds(rows, "id", "label").collect()}
    two = {r.id: r.fold for r in ranks.stratified_folds(rows.orderBy(F.rand(1)).repartition(7), "id", "label").collect()}
    assert one == two


def test_spearman_like_pandas(spark):
    draw = np.random.default_rng(4)
    frame = pd.DataFrame({"x": draw.integers(0, 3, 300).astype(float), "y": draw.normal(size=300).round(1)})
    frame["y"] += frame["x"]
    frame.loc[:20, "y"] = np.nan
    row = association.spearman(spark.createDataFrame(frame), "x", "y", "s", buckets=8).first()
    valid = frame.dropna()
    assert row.n == len(valid)
    assert abs(row.rho - valid.x.rank().corr(valid.y.rank())) < 1e-12
    assert row.p < 1e-10


def test_spearman_of_few_or_constant_rows(spark):
    few = association.spearman(spark.createDataFrame([(1.0, 2.0), (2.0, 1.0)], "x double, y double"), "x", "y", "s").first()
    assert (few.n, few.rho, few.p) == (2, None, None)
    flat = association.spearman(spark.createDataFrame([(1.0, float(i)) for i in range(5)], "x double, y double"), "x", "y", "s").first()
    assert (flat.n, flat.rho, flat.p) == (5, None, None)


def p_values(spark, given):
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(given)], "i int, rho double, n bigint")
    return [r.p for r in rows.select("i", correlation_p(F.col("rho"), F.col("n")).alias("p")).orderBy("i").collect()]


def test_p_values_of_few_rows(spark):
    rhos = [-0.999, -0.5, 0.0, 1e-9, 0.3, 0.9, 0.999999]
    for n, exact in [(3, lambda r: 1 - 2 / math.pi * math.asin(abs(r))), (4, lambda r: 1 - abs(r))]:
        for found, r in zip(p_values(spark, [(r, n) for r in rhos]), rhos):
            assert abs(found / exact(r) - 1) < 1e-9
    assert p_values(spark, [(1.0, 9), (-1.0, 9), (0.5, 2), (None, 9)]) == [0.0, 0.0, None, None]
    assert abs(p_values(spark, [(0.758, 10)])[0] - 0.0111) < 1e-3


def test_p_values_reach_the_normal_limit(spark):
    for t in (0.01, 1.96, 2.575829303549, 8.0, 30.0):
        for n in (10**9, 10**13, 10**15, 10**16, 10**18):
            found = p_values(spark, [(t / math.sqrt(n - 2 + t * t), n)])[0]
            assert abs(found / math.erfc(t / math.sqrt(2)) - 1) < 1e-9 + t**4 / n


def test_correlations_of_groups_with_ties(spark):
    draw = np.random.default_rng(5)
    frame = pd.DataFrame({"g": draw.integers(0, 4, 2000), "x": draw.integers(0, 3, 2000), "y": draw.normal(size=2000).round(1)})
    frame.loc[frame.g < 2, "x"] = 1 + frame.x % 2
    found = association.correlations_by(spark.createDataFrame(frame), ["g"], "x", "y", buckets=8).collect()
    assert len(found) == 4
    for row in found:
        part = frame[frame.g == row.g]
        assert row.n == len(part) and abs(row.rho - part.x.rank().corr(part.y.rank())) < 1e-12


def test_correlations_list_scores_without_values(spark):
    rows = spark.createDataFrame([(float(i), float(-i), None) for i in range(5)], "y double, a double, b double")
    found = {r.score: r[1:] for r in association.correlations(rows, "y", {"a": "a", "b": "b"}).collect()}
    assert found["b"] == (0, None, None) and len(found) == 2
    assert found["a"][0] == 5 and found["a"][1:] == pytest.approx((-1.0, 0.0), abs=1e-9)


def test_box_whiskers(spark):
    rows = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 100]] + [("b", None)], "c string, v double")
    row = association.box_summary(rows, "v", "c").collect()
    assert [(r.c, r.n, r.q1, r["median"], r.q3, r.whisker_low, r.whisker_high) for r in row] == [("a", 5, 2.0, 3.0, 4.0, 1.0, 4.0)]


def test_correlations_deal_more_tasks_to_more_rows(spark, monkeypatch):
    """The memory of a task follows ``ROWS_PER_TASK``, not the rows; the session's settings come back."""
    key, dealt = "spark.sql.shuffle.partitions", []
    usual, write = spark.conf.get(key), association.written
    monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
    monkeypatch.setattr(association, "written", lambda df, name: dealt.append((name, spark.conf.get(key))) or write(df, name))
    draw = np.random.default_rng(4)
    frame = pd.DataFrame({"g": np.arange(300) % 60, "x": draw.random(300), "y": draw.random(300)})
    found = {r.g: r.rho for r in association.correlations_by(spark.createDataFrame(frame), ["g"], "x", "y").collect()}
    assert dealt == [("pairs", "30"), ("ranks", "60"), ("correlation-sums", "60")]
    assert spark.conf.get(key) == usual
    expected = {g: f.x.rank().corr(f.y.rank()) for g, f in frame.groupby("g")}
    assert found == pytest.approx(expected)


def grouped(seed=6):
    """900 groups of four rows with ties, missing numbers and both zeros, and one group with most rows."""
    draw = np.random.default_rng(seed)
    frame = pd.DataFrame({"g": np.r_[np.arange(3600) % 900, np.full(6400, 900)], "x": draw.integers(-2, 3, 10_000).astype(float), "y": draw.random(10_000).round(2)})
    frame.loc[frame.index % 31 == 0, "x"] = -0.0
    frame.loc[frame.index % 37 == 0, "y"] = np.nan
    return frame.sample(frac=1, random_state=seed)


def spearman_by_group(frame):
    found = {}
    for g, f in frame.dropna().groupby("g"):
        flat = f.x.nunique() < 2 or f.y.nunique() < 2
        found[g] = (len(f), None if flat or len(f) < 3 else pytest.approx(f.x.rank().corr(f.y.rank()), abs=1e-12))
    return found


def as_rows(spark, frame):
    return spark.createDataFrame(frame).withColumn("y", F.nanvl("y", F.lit(None)))


def test_small_groups_are_shuffled_once(spark, monkeypatch):
    """Disk: of 901 groups only the large one is written as pairs and ranks; one shuffle ranks and sums the others."""
    kept, write = {}, association.written

    def watch(df, name):
        table = write(df, name)
        kept[name] = (df, table.select("g").distinct().collect())
        return table

    monkeypatch.setattr(association, "written", watch)
    frame = grouped()
    found = {r.g: (r.n, r.rho) for r in association.correlations_by(as_rows(spark, frame), ["g"], "x", "y").collect()}
    assert found == spearman_by_group(frame)
    assert [r.g for r in kept["pairs"][1]] == [r.g for r in kept["ranks"][1]] == [900]
    small = association._sums(association._ranked_whole(as_rows(spark, frame), ["g"]), ["g"])
    assert small._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(g") == 1


@pytest.mark.parametrize("large", [[], [900], list(range(0, 901, 2)), list(range(901))])
def test_correlations_do_not_depend_on_what_is_large(spark, monkeypatch, large):
    monkeypatch.setattr(association, "_large_groups", lambda rows, by, total: spark.createDataFrame([(g,) for g in large], "g bigint"))
    frame = grouped()
    found = {r.g: (r.n, r.rho) for r in association.correlations_by(as_rows(spark, frame), ["g"], "x", "y").collect()}
    assert found == spearman_by_group(frame)


def test_correlations_without_a_key(spark):
    """All rows are one group if there is no key to group by; the rows of a null key are counted and have no rank."""
    frame = grouped().dropna()
    row = association.correlations_by(as_rows(spark, frame), [], "x", "y").first()
    assert (row.n, row.rho) == (len(frame), pytest.approx(frame.x.rank().corr(frame.y.rank()), abs=1e-12))
    keys = as_rows(spark, frame).withColumn("g", F.when(F.col("g") < 2, None).otherwise(F.col("g")))
    found = {r.g: (r.n, r.rho) for r in association.correlations_by(keys, ["g"], "x", "y").collect()}
    assert found == {**spearman_by_group(frame[frame.g > 1]), None: (int((frame.g < 2).sum()), None)}


def test_a_sample_finds_the_large_groups(spark):
    """Of 2,000,000 rows a fifth is drawn: 2000 groups have 500 each, half of what is large, and one has the rest."""
    rows = spark.range(2_000_000).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.expr("id div 2 % 2000")).alias("g"))
    assert [r.g for r in association._large_groups(rows, ["g"], 2_000_000).collect()] == [-1]
