import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tamarack.functions import vocab
from tamarack.operators import attribution, features, scoring, selftrain
from tamarack.plans import experiment
from tamarack.streaming.scoring import score_uploads

FEATURES = "most_severe_consequence string, vep_impact string, gnomad_af double, phylop100way double, gerp_score double"


def rows(spark, n, seed, labelled=True):
    """Variants whose class follows from impact and conservation, with some noise and some missing numbers."""
    draw = random.Random(seed)
    made = []
    for i in range(n):
        impact = draw.choice(["HIGH", "MODERATE", "LOW"])
        label = {"HIGH": "No function", "MODERATE": "Decreased function", "LOW": "Normal function"}[impact]
        score = {"HIGH": 5.0, "MODERATE": 2.0, "LOW": -1.0}[impact] + draw.gauss(0, 1.5)
        term = draw.choice({"HIGH": ["stop_gained", "missense_variant"], "MODERATE": ["missense_variant"], "LOW": ["intron_variant"]}[impact])
        made.append((
            str(seed * 10_000 + i), f"variant {i}", "GENE", term, impact, None if draw.random() < 0.2 else draw.random(),
            score, None if draw.random() < 0.1 else score * 2, label if labelled else None,
        ))
    schema = f"VariationID string, Name string, GeneSymbol string, {FEATURES}, function_term string"
    return spark.createDataFrame(made, schema)


SETTING = experiment.Setting(folds=3, trees=8, depth=4, boost_rounds=2, boost_depth=2, threshold=0.7, max_rounds=3)


@pytest.fixture(scope="module")
def gold(spark):
    return experiment.training_rows(rows(spark, 60, 1)).persist()


@pytest.fixture(scope="module")
def pool(spark):
    return experiment.pool_rows(rows(spark, 80, 2, labelled=False)).persist()


@pytest.fixture(scope="module")
def bundle(gold):
    return experiment.final_bundle(gold, SETTING, vocab.REQUIRED_SCORING_COLUMNS)


def test_preprocessor(spark):
    train = spark.createDataFrame(
        [(1.0, 7.0, "b"), (2.0, 7.0, "a"), (4.0, 7.0, "a'\\"), (8.0, None, None), (None, 7.0, "a")], "x double, y double, c string"
    )
    fitted = features.fit_preprocessor(train, ["x", "y"], "c")
    assert fitted.feature_names == ["num__x", "num__y", "cat__c_a", "cat__c_a'\\", "cat__c_b"]
    probe = spark.createDataFrame([(None, float("nan"), None), (8.0, 8.0, "new"), (3.0, 7.0, "a'\\")], "x double, y double, c string")
    found = [r[0] for r in fitted.transform(probe).select(vector_to_array("features")).collect()]
    filled = np.array([1, 2, 4, 8, 3.0])
    scale = lambda v: (v - filled.mean()) / filled.std()
    np.testing.assert_allclose(found, [[scale(3), 0, 1, 0, 0], [scale(8), 1, 0, 0, 0], [scale(3), 0, 0, 1, 0]], atol=1e-12)


def test_balanced_weights(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",)], "y string")
    weights = {r.y: r.w for r in df.withColumn("w", features.class_weight({"a": 3, "b": 1}, "y")).collect()}
    assert weights == {"a": 4 / 6, "b": 2.0}


def test_model_comparison(gold):
    table = {r.model: r for r in experiment.compare_models(gold, SETTING).collect()}
    assert set(table) == {"LogisticRegression", "RandomForest", "BoostedTrees"}
    for row in table.values():
        assert row.accuracy > 0.6 and 0 <= row.accuracy_std < 0.5 and row.f1_No_function > 0.5


def test_self_training_keeps_every_row(gold, pool):
    result = experiment.train_iteratively(gold, pool, SETTING)
    log = result.log.orderBy("iteration").collect()
    n_gold, n_pool = gold.count(), pool.count()
    assert log and sum(r.n_pseudo_added for r in log) == result.pseudo.count()
    for row in log:
        assert row.n_total_labeled + row.n_remaining_unlabeled == n_gold + n_pool
    assert result.labelled.count() + result.remaining.count() == n_gold + n_pool
    assert result.labelled.select("VariationID").distinct().count() == result.labelled.count()


def frequency(spark, pool_rows, threshold, rounds=10):
    gold_rows = spark.createDataFrame([(i, "x", "a") for i in range(3)] + [(9, "y", "a"), (10, "y", "b")], "id int, cell string, label string")
    scorer = selftrain.frequency_scorer("label", ["a", "b"], [["cell"]])
    return selftrain.self_train(gold_rows, spark.createDataFrame(pool_rows, "id int, cell string"), "id", "label", ["cell"], scorer, threshold, rounds)


def test_self_training_stops(spark):
    some = frequency(spark, [(20, "x"), (21, "y"), (22, "unseen")], 0.85)
    assert [(r.iteration, r.n_pseudo_added, r.n_remaining_unlabeled, r.pseudo_label_dist) for r in some.log.collect()] == [(1, 1, 2, "{'a': 1}")]
    assert {r.id for r in some.remaining.collect()} == {21, 22}
    assert frequency(spark, [], 0.85).log.count() == 0
    assert frequency(spark, [(20, "y")], 0.85).log.count() == 0
    exact = frequency(spark, [(20, "y")], 0.5)  # the threshold counts as reached; the first class wins the tie
    assert [(r.id, r.label, r.round) for r in exact.pseudo.collect()] == [(20, "a", 1)]


class Killed(Exception):
    pass


def test_self_training_goes_on_after_a_lost_driver(spark, tmp_path):
    """The driver goes after round 2, and once more in the middle of round 3; ids repeat, and one row has none."""
    gold_rows = spark.createDataFrame([(i, f"c{i % 7}", "a" if i % 3 else "b") for i in range(60)], "id int, cell string, label string")
    made = [(100 + i // 2, f"c{i % 9}") for i in range(200)] + [(None, "c1"), (None, "c8")]
    pool_rows = spark.createDataFrame(made, "id int, cell string")

    def scorer(upto):
        """Round n takes the cells up to n; the driver is lost after round ``upto``."""
        def fit(labelled):
            number = labelled.agg(F.max("round")).first()[0] + 1
            if number > upto:
                raise Killed
            share = F.when(F.expr("substring(cell, 2)").cast("int") <= number, 0.9).otherwise(0.1)
            return lambda rows: rows.withColumns({"_pred_class": F.when(F.col("cell") == "c1", "a").otherwise("b"), "_confidence": share})
        return fit

    def train(folder, upto):
        return selftrain.self_train(gold_rows, pool_rows, "id", "label", ["cell"], scorer(upto), 0.5, 5, str(tmp_path / folder))

    whole = train("whole", 99)
    with pytest.raises(Killed):
        train("lost", 2)
    assert len(selftrain.Rounds(str(tmp_path / "lost"), gold_rows, pool_rows, "label").log()) == 2
    # Round 3 was written, its line in the log was not.
    spark.range(3).select(F.col("id").alias("_row"), F.lit("b").alias("label"), F.lit(True).alias("_taken")).write.parquet(str(tmp_path / "lost" / "round-3"))
    again = train("lost", 99)
    for part in ("log", "labelled", "remaining"):
        assert sorted(map(repr, getattr(again, part).collect())) == sorted(map(repr, getattr(whole, part).collect())), part
    assert again.ended == whole.ended == "last round" and whole.log.count() == 5
    assert again.labelled.count() + again.remaining.count() == 60 + 202
    finished = train("lost", 0)  # nothing is left to do
    assert sorted(map(repr, finished.labelled.collect())) == sorted(map(repr, whole.labelled.collect()))
    assert not {"cell", "id"} & set(spark.read.parquet(str(tmp_path / "lost" / "round-1")).columns)


@pytest.mark.parametrize("nested", [False, True])
def test_phases(gold, pool, nested):
    setting = experiment.Setting(folds=2, trees=4, depth=3, threshold=0.7, max_rounds=1)
    phases = experiment.compare_phases(gold, pool, setting, nested)
    table = {r.tag: r for r in phases.comparison.collect()}
    assert table["Phase1_Supervised_Baseline"].n_pseudo_labeled == 0
    assert table["Phase2_SemiSupervised_Honest"].n_pseudo_labeled == phases.training.pseudo.count() > 0
    matrix = phases.confusion.collect()
    assert sum(sum(r[c] for c in phases.confusion.columns if c != "actual") for r in matrix) == gold.count()


def test_an_experiment_makes_its_features_once(gold, pool, tmp_path, monkeypatch):
    """Every fit, fold and round reads written features, not what they are made from."""
    class Stop(Exception):
        pass

    def compare_phases(gold, pool, setting):
        assert gold.inputFiles() and pool.inputFiles()
        assert gold.columns == [SETTING.row_id, *SETTING.features, SETTING.label] and pool.columns == gold.columns[:-1]
        raise Stop

    monkeypatch.setattr(experiment, "compare_models", lambda gold, setting: gold)
    monkeypatch.setattr(experiment, "compare_phases", compare_phases)
    with pytest.raises(Stop):
        experiment.write_experiment(str(tmp_path), gold, pool, SETTING)
    assert gold.sparkSession.read.csv(f"{tmp_path}/model_comparison", header=True).count() == gold.count()


def subset_shapley(x, leaves):
    """Shapley values by enumerating every subset of features."""
    n = len(x)

    def expectation(known):
        total = 0.0
        for leaf in leaves:
            reach = 1.0
            for f, low, high, share in zip(leaf.feature, leaf.low, leaf.high, leaf.share):
                reach *= float(low < x[f] <= high) if f in known else share
            total = total + reach * np.array(leaf.value)
        return total

    values = []
    for f in range(n):
        others = [g for g in range(n) if g != f]
        value = 0.0
        for size in range(n):
            weight = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
            for known in itertools.combinations(others, size):
                value = value + weight * (expectation({*known, f}) - expectation(set(known)))
        values.append(value)
    return np.array(values).T


def test_attributions(gold, bundle):
    explained = scoring.explain(gold, bundle).select(vector_to_array("features").alias("x"), vector_to_array("probability").alias("p"), "phi").collect()
    leaves = bundle.paths.collect()
    trees = len({leaf.tree for leaf in leaves})
    base = np.array([r.base for r in attribution.base_values(bundle.paths).orderBy("class_index").collect()])
    shape = (len(bundle.classes), len(bundle.feature_names))
    for row in explained:
        phi = np.array(row.phi).reshape(shape)
        np.testing.assert_allclose(phi.sum(axis=1) + base, row.p, atol=1e-9)
    for row in explained[:4]:
        np.testing.assert_allclose(np.array(row.phi).reshape(shape), subset_shapley(row.x, leaves) / trees, atol=1e-9)


def test_importance_tables(gold, bundle):
    table = experiment.attribution_table(gold, bundle)
    assert table.count() == len(bundle.classes) * len(bundle.feature_names)
    phi = np.array([r.phi for r in scoring.explain(gold, bundle).collect()])
    expected = np.abs(phi).mean(axis=0).reshape(len(bundle.classes), -1)
    for row in table.collect():
        assert abs(row.mean_abs_shap - expected[bundle.classes.index(row["class"]), bundle.feature_names.index(row.feature)]) < 1e-12
    best = attribution.top_features(attribution.overall_importance(table), 2).collect()
    assert [r.feature for r in best] == [bundle.feature_names[i] for i in np.argsort(-expected.mean(axis=0))[:2]]
    both = experiment.compare_attributions(table, table.filter("feature <> 'num__gnomad_af'"))
    missing = both.filter("feature = 'num__gnomad_af'").first()
    assert missing.rank1 is not None and missing.rank2 is None


def test_saved_bundle_scores_like_the_fitted_one(spark, bundle, tmp_path):
    assert scoring.load_bundle(spark, str(tmp_path / "none")) is None
    path = str(tmp_path / "bundle")
    bundle.save(path)
    loaded = scoring.load_bundle(spark, path)
    assert (loaded.classes, loaded.feature_names, loaded.n_gold, loaded.n_pseudo) == (bundle.classes, bundle.feature_names, 60, 0)
    fresh = rows(spark, 20, 3).select(*vocab.SCORING_COLUMNS)
    key = ["Name", "_pred_class", "_confidence", "_top_feature"]
    scored = scoring.score(fresh, loaded)
    assert sorted(map(tuple, scored.select(key).collect())) == sorted(map(tuple, scoring.score(fresh, bundle).select(key).collect()))
    assert scoring.prediction_table(scored).columns == [*vocab.SCORING_COLUMNS, "Predicted Class", "Confidence", "Top Feature"]
    allowed = {name.replace("num__", "").replace("cat__most_severe_consequence_", "") for name in bundle.feature_names}
    assert {r["_top_feature"] for r in scored.collect()} <= allowed
    with pytest.raises(ValueError, match="vep_impact"):
        scoring.score(fresh.drop("vep_impact"), loaded)


def test_scoring_by_cell(spark, bundle, gold, monkeypatch):
    """The same rows; leaves in several blocks, hot cells, and a plan of a few levels at a time."""
    fresh = rows(spark, 200, 8).select(*vocab.SCORING_COLUMNS)
    fresh = fresh.unionAll(fresh.limit(1).crossJoin(spark.range(300)).drop("id"))
    expected = sorted(map(tuple, scoring.score(fresh, bundle).collect()), key=repr)
    monkeypatch.setattr(attribution, "ENTRIES", 40)
    assert sorted(map(tuple, scoring.score(fresh, bundle, by_cell=True).collect()), key=repr) == expected
    monkeypatch.setattr(attribution, "LEVELS", 2)
    paths = lambda t: sorted((r.tree, r.leaf, sorted(zip(r.feature, r.low, r.high, r.share)), r.value) for r in t.collect())
    assert paths(attribution.leaf_paths(bundle.pipeline.stages[-1])) == paths(bundle.paths)


def test_cells_do_not_grow_with_copies(spark, bundle, gold):
    prepared = bundle.pipeline.transform(gold)
    once = attribution.attributed_cells(prepared, bundle.paths)
    many = attribution.attributed_cells(prepared.crossJoin(spark.range(50)), bundle.paths)
    assert {tuple(r.cell): (50 * r.n, r.phi) for r in once.collect()} == {tuple(r.cell): (r.n, r.phi) for r in many.collect()}


def test_scoring_needs_no_shuffle(spark, bundle):
    plan = scoring.score(rows(spark, 5, 4).select(*vocab.SCORING_COLUMNS), bundle)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_uploads_are_scored_as_they_arrive(spark, bundle, tmp_path):
    fresh = rows(spark, 12, 5).select(*vocab.SCORING_COLUMNS)
    fresh.write.option("header", True).csv(str(tmp_path / "uploads"))
    for _ in range(2):  # the second run finds nothing new
        score_uploads(spark, str(tmp_path / "uploads"), str(tmp_path / "out"), str(tmp_path / "ckpt"), bundle).awaitTermination(120)
    streamed = spark.read.option("header", True).option("recursiveFileLookup", True).csv(str(tmp_path / "out"))
    batch = scoring.prediction_table(scoring.score(fresh, bundle))
    pair = [F.col("Name"), F.col("`Predicted Class`"), F.col("`Top Feature`")]
    assert sorted(map(tuple, streamed.select(pair).collect())) == sorted(map(tuple, batch.select(pair).collect()))


def test_uploads_in_another_order_with_more_columns(spark, bundle, tmp_path):
    names = ["gerp_score", "vep_impact", "sample", "Name", "most_severe_consequence", "GeneSymbol", "phylop100way", "gnomad_af"]
    lines = [["4.5", "HIGH", "s1", "one", "stop_gained", "G1", "3.1", "NA"], ["", "NA", "s2", "two", "missense_variant", "G2", "0.1", "0.25"]]
    (tmp_path / "uploads").mkdir()
    (tmp_path / "uploads" / "up.csv").write_text("\n".join(",".join(x) for x in [names, *lines]) + "\n")
    score_uploads(spark, str(tmp_path / "uploads"), str(tmp_path / "out"), str(tmp_path / "ckpt"), bundle).awaitTermination(120)
    got = spark.read.option("header", True).csv(str(tmp_path / "out" / "up.csv"))
    assert got.columns == [*names, "Predicted Class", "Confidence", "Top Feature"]
    known = spark.createDataFrame([("one", "G1", "stop_gained", "HIGH", None, 3.1, 4.5), ("two", "G2", "missense_variant", None, 0.25, 0.1, None)], "Name string, GeneSymbol string, most_severe_consequence string, vep_impact string, gnomad_af double, phylop100way double, gerp_score double")
    expected = {r.Name: (r["Predicted Class"], r["Top Feature"]) for r in scoring.prediction_table(scoring.score(known, bundle)).collect()}
    assert {r.Name: (r["Predicted Class"], r["Top Feature"]) for r in got.collect()} == expected
    assert {r.Name: (r.sample, r.gnomad_af, r.vep_impact) for r in got.collect()} == {"one": ("s1", None, "HIGH"), "two": ("s2", "0.25", None)}


def test_outside_scores(spark):
    draw = random.Random(6)
    terms = ["No function", "Decreased function", "Normal function", "Increased function"]
    made = [(t := draw.choice(terms), 2.0 - terms.index(t) + draw.random(), None if i > 1 else 1.0) for i in range(60)]
    table, boxes = experiment.outside_scores(spark.createDataFrame(made, "function_term string, revel_score double, cadd_phred double"))
    found = {r.score: r for r in table.collect()}
    assert found["REVEL"].rho < -0.8 and found["REVEL"].p < 1e-6 and found["CADD"].rho is None and found["CADD"].n <= 2
    # Too few values of the other score for a box.
    assert {(r.score, r.function_term) for r in boxes.collect()} == {("REVEL", term) for term in terms[:3]}


def test_rows_of_a_cell_share_their_attributions():
    draw = np.random.default_rng(9)
    leaves = {
        "feature": np.array([[0, 1], [1, 2], [0, 2]]), "low": np.array([[-np.inf, 0.5], [-np.inf, 0.2], [0.3, -np.inf]]),
        "high": np.array([[0.3, np.inf], [0.5, np.inf], [np.inf, 0.2]]), "share": np.array([[0.4, 0.5], [0.5, 0.3], [0.6, 0.7]]),
        "value": np.array([[0.1, 0.9], [0.8, 0.2], [0.5, 0.5]]),
    }
    x = draw.random((500, 3)).round(1)
    x[:5, 1] = np.nan
    first, cell = attribution.distinct_cells(x, {0: [0.3], 1: [0.2, 0.5], 2: [0.2]})
    assert len(first) < 20
    np.testing.assert_allclose(attribution.shapley(x[first], leaves)[cell], attribution.shapley(x, leaves), atol=1e-12)
