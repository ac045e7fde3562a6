"""Classification metrics from confusion counts.

Predictions are reduced once to (by..., actual, predicted, n); everything else is computed from those few rows.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.functions.text import snake_label
from tamarack.operators.summaries import listed


def confusion_counts(predictions: DataFrame, by: list[str], actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return predictions.groupBy(*by, F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def accuracy(counts: DataFrame, by: list[str]) -> DataFrame:
    right = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0))
    return counts.groupBy(*by).agg((right / F.sum("n")).alias("accuracy"))


def class_report(counts: DataFrame, by: list[str]) -> DataFrame:
    """(by..., class, precision, recall, f1, support) over the classes seen as truth or prediction; 0/0 is 0."""
    zero, hit = F.lit(0).cast("bigint"), F.col("actual") == F.col("predicted")
    roles = F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("support"), zero.alias("guessed"),
                 F.when(hit, F.col("n")).otherwise(zero).alias("right")),
        F.struct(F.col("predicted").alias("class"), zero.alias("support"), F.col("n").alias("guessed"),
                 zero.alias("right")),
    )
    totals = counts.select(*by, F.inline(roles)).groupBy(*by, "class").agg(
        F.sum("support").alias("support"), F.sum("guessed").alias("guessed"), F.sum("right").alias("right")
    )

    def ratio(top, bottom):
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    return totals.select(
        *by, "class",
        ratio(F.col("right"), F.col("guessed")).alias("precision"),
        ratio(F.col("right"), F.col("support")).alias("recall"),
        ratio(F.col("right") * 2, F.col("guessed") + F.col("support")).alias("f1"),
        "support",
    )


def averaged_report(report: DataFrame, by: list[str]) -> DataFrame:
    """The macro and the support-weighted means, as two rows in the shape of the class report."""
    measures = ["precision", "recall", "f1"]
    means = report.groupBy(*by).agg(
        F.struct(F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in measures]).alias("_macro"),
        F.struct(
            F.lit("weighted avg").alias("class"), *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in measures]
        ).alias("_weighted"),
        F.sum("support").alias("support"),
    )
    return means.select(*by, F.inline(F.array("_macro", "_weighted")), "support")


def macro_f1(counts: DataFrame, by: list[str]) -> DataFrame:
    return class_report(counts, by).groupBy(*by).agg(F.avg("f1").alias("macro_f1"))


def confusion_matrix(counts: DataFrame, classes: list[str]) -> DataFrame:
    """One row per true class and one column per predicted class, zero-filled."""
    spread = counts.filter(F.col("actual").isin(classes)).groupBy("actual").pivot("predicted", classes).agg(F.sum("n"))
    return listed(counts.sparkSession, classes, "actual").join(spread, "actual", "left").fillna(0, classes)


def cv_summary(predictions: DataFrame, model: str, fold: str, classes: list[str]) -> DataFrame:
    """One row per model: pooled metrics, mean and population deviation over folds, and ``f1_<class>`` columns."""
    by_fold = confusion_counts(predictions, [model, fold])
    pooled = by_fold.groupBy(model, "actual", "predicted").agg(F.sum("n").alias("n"))
    folds = accuracy(by_fold, [model, fold]).join(macro_f1(by_fold, [model, fold]), [model, fold]).groupBy(model).agg(
        *[fn(m).alias(f"{m}_{end}") for m in ("accuracy", "macro_f1") for fn, end in ((F.avg, "mean"), (F.stddev_pop, "std"))]
    )
    names = {f"f1_{c}": f"f1_{c.replace(' ', '_')}" for c in classes}
    f1 = class_report(pooled, [model]).withColumn("class", F.concat(F.lit("f1_"), snake_label(F.col("class"))))
    per_class = f1.groupBy(model).pivot("class", list(names.values())).agg(F.max("f1"))
    summary = accuracy(pooled, [model]).join(macro_f1(pooled, [model]), model).join(folds, model).join(per_class, model)
    return summary.select(
        model, "accuracy", "accuracy_mean", "accuracy_std", "macro_f1", "macro_f1_mean", "macro_f1_std", *names.values()
    )
