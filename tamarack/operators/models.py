"""Classifiers, predictions, and the metadata they travel with."""

from collections.abc import Callable

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel, OneVsRest, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.functions.vocab import LOGISTIC_ITERATIONS, SEED, TREES
from tamarack.operators.features import class_name
from tamarack.session import written

COLUMNS = {"featuresCol": "features", "labelCol": "_class", "weightCol": "_weight"}


def logistic_regression(n_rows: int, iterations: int = LOGISTIC_ITERATIONS) -> LogisticRegression:
    """Unit-strength L2 on the summed loss is 1 / (total weight) on the mean loss; balanced weights sum to the rows."""
    return LogisticRegression(family="multinomial", maxIter=iterations, regParam=1.0 / n_rows, standardization=False, tol=1e-9, **COLUMNS)


def random_forest(trees: int = TREES, depth: int = 30, seed: int = SEED) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=seed, **COLUMNS)


def boosted_trees(rounds: int = TREES, depth: int = 6, seed: int = SEED) -> OneVsRest:
    base = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=seed)
    return OneVsRest(classifier=base, parallelism=4, **COLUMNS)


def model_set(n_rows: int, trees: int = TREES, depth: int = 30, rounds: int = TREES, boost_depth: int = 6, seed: int = SEED) -> dict:
    return {
        "LogisticRegression": logistic_regression(n_rows),
        "RandomForest": random_forest(trees, depth, seed),
        "BoostedTrees": boosted_trees(rounds, boost_depth, seed),
    }


def logistic_gradient(model: LogisticRegressionModel, rows: DataFrame, classes: list[str], features: list[str]) -> DataFrame:
    """(class, feature, gradient): of the penalised mean loss at the fitted coefficients, over all rows; 0 at the optimum.

    The loss is convex, so small gradients certify the fit. ``rows`` are the training rows, prepared. One aggregate of
    (features + 1) * classes sums; the intercept comes last and is not penalised.
    """
    x = F.concat(vector_to_array("features"), F.array(F.lit(1.0)))
    residual = F.transform(vector_to_array("probability"), lambda p, k: F.col("_weight") * (p - F.when(F.col("_class") == k, 1.0).otherwise(0.0)))
    products = F.flatten(F.transform(residual, lambda r: F.transform("_x", lambda v: r * v)))
    each = model.transform(rows).withColumn("_x", x).select("_weight", array_to_vector(products).alias("_products"))
    sums = each.agg(F.sum("_weight").alias("total"), Summarizer.metrics("sum").summary(F.col("_products")).alias("s"))
    penalty, beta = model.getOrDefault("regParam"), model.coefficientMatrix.toArray()
    names, size = [*features, "intercept"], len(features)
    places = [
        F.struct(F.lit(c).alias("class"), F.lit(name).alias("feature"), (F.get("_sums", k * (size + 1) + j) / F.col("total") + F.lit(penalty * float(beta[k, j]) if j < size else 0.0)).alias("gradient"))
        for k, c in enumerate(classes) for j, name in enumerate(names)
    ]
    return sums.withColumn("_sums", vector_to_array("s.sum")).select(F.inline(F.array(*places)))


class ClassShares(Estimator):
    """Predicts the class of the largest weight among the training rows of the same cell, the first one of several.

    ``cell`` makes the cell of an array of features. A transparent baseline: what it predicts can be written in SQL.
    """

    def __init__(self, cell: Callable[[Column], Column], classes: int):
        super().__init__()
        self.cell, self.classes = cell, classes

    def _fit(self, dataset: DataFrame) -> "ClassSharesModel":
        weight = [F.count_if(F.col("_class") == k) * F.max(F.when(F.col("_class") == k, F.col("_weight"))) for k in range(self.classes)]
        shares = F.array(*[F.coalesce(w, F.lit(0.0)) for w in weight])
        cells = dataset.groupBy(self.cell(vector_to_array("features")).alias("_cell")).agg(shares.alias("_shares"))
        # One row per cell: written, so that its size decides how it is joined.
        return ClassSharesModel(self.cell, written(cells.select("_cell", top_class(F.col("_shares"), [])[0].cast("double").alias("prediction")), "cells"))


class ClassSharesModel(Model):
    def __init__(self, cell: Callable[[Column], Column], cells: DataFrame):
        super().__init__()
        self.cell, self.cells = cell, cells

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Rows of a cell without training rows get the first class."""
        placed = dataset.withColumn("_cell", self.cell(vector_to_array("features"))).join(self.cells, "_cell", "left")
        return placed.drop("_cell").withColumn("prediction", F.coalesce("prediction", F.lit(0.0)))


def top_class(probabilities: Column, classes: list[str]) -> tuple[Column, Column, Column]:
    """(index, class, confidence) of the most probable class; the first one wins ties."""
    confidence = F.array_max(probabilities)
    index = (F.array_position(probabilities, confidence) - 1).cast("int")
    return index, class_name(index, classes) if classes else F.lit(None), confidence


def with_top_class(df: DataFrame, classes: list[str], probability: str = "probability") -> DataFrame:
    """Adds ``_pred_index``, ``_pred_class`` and ``_confidence``."""
    index, name, confidence = top_class(vector_to_array(probability), classes)
    return df.withColumns({"_pred_index": index, "_pred_class": name, "_confidence": confidence})
