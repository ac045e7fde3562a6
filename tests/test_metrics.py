from tamarack.operators import metrics


def predictions(spark):
    rows = [("m", 0, "a", "a"), ("m", 0, "a", "b"), ("m", 0, "b", "b"), ("m", 1, "b", "c"), ("m", 1, "a", "a"), ("m", 1, "b", "b")]
    return spark.createDataFrame(rows, "model string, fold int, actual string, predicted string")


def test_report_covers_classes_only_ever_predicted(spark):
    counts = metrics.confusion_counts(predictions(spark), ["model"])
    report = {r["class"]: (r.precision, r.recall, r.f1, r.support) for r in metrics.class_report(counts, ["model"]).collect()}
    assert report == {"a": (1.0, 2 / 3, 0.8, 3), "b": (2 / 3, 2 / 3, 2 / 3, 3), "c": (0.0, 0.0, 0.0, 0)}
    assert abs(metrics.macro_f1(counts, ["model"]).first().macro_f1 - (0.8 + 2 / 3) / 3) < 1e-12
    means = {r["class"]: r for r in metrics.averaged_report(metrics.class_report(counts, ["model"]), ["model"]).collect()}
    assert abs(means["weighted avg"].f1 - (0.8 * 3 + 2 / 3 * 3) / 6) < 1e-12 and means["macro avg"].support == 6


def test_summary_pools_and_averages_over_folds(spark):
    row = metrics.cv_summary(predictions(spark), "model", "fold", ["a", "b", "no seen"]).first()
    assert abs(row.accuracy - 4 / 6) < 1e-12 and abs(row.accuracy_mean - 2 / 3) < 1e-12 and abs(row.accuracy_std) < 1e-12
    folds = [(2 / 3 + 2 / 3) / 2, (1 + 2 / 3 + 0) / 3]
    assert abs(row.macro_f1_mean - sum(folds) / 2) < 1e-12 and abs(row.macro_f1_std - abs(folds[0] - folds[1]) / 2) < 1e-12
    assert row.f1_no_seen is None and abs(row.f1_a - 0.8) < 1e-12


def test_confusion_matrix_is_zero_filled(spark):
    counts = metrics.confusion_counts(predictions(spark), [])
    found = {r.actual: (r.a, r.b, r.c) for r in metrics.confusion_matrix(counts, ["a", "b", "c"]).collect()}
    assert found == {"a": (2, 1, 0), "b": (0, 2, 1), "c": (0, 0, 0)}
