"""Stratified cross-validation with everything fitted inside the fold."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.functions.vocab import FOLDS, SEED
from tamarack.operators.features import class_index, class_name, class_weight, preprocessor_of
from tamarack.operators.ranks import stratified_folds
from tamarack.operators.training import figures_of, figures_without
from tamarack.session import discard, written

Models = Callable[[int], dict[str, Estimator]]
#: The fold of rows that every fold trains on and none is tested on.
ALWAYS = -1


def out_of_fold_predictions(
    gold: DataFrame, row_id: str, label: str, numeric: list[str], categorical: str, classes: list[str], models: Models,
    folds: int = FOLDS, seed: int = SEED, extra: DataFrame | Callable[[DataFrame], DataFrame] | None = None, parallelism: int = 3,
) -> DataFrame:
    """(model, fold, row_id, actual, predicted), each gold row once per model.

    Test folds hold gold rows only. ``extra`` are further training rows of every fold, or maps the gold training rows of
    a fold to its own. What the preparation takes from the training rows of each fold is counted for all folds at once.
    Up to ``parallelism`` folds are fitted at the same time. The table is written once; every metric and the confusion
    matrix read it.
    """
    columns = [row_id, label, *numeric, categorical]
    rows = stratified_folds(gold.select(*columns), row_id, label, folds, seed)
    if isinstance(extra, DataFrame):
        rows = rows.unionByName(extra.select(*columns, F.lit(ALWAYS).alias("fold")))
    rows = written(rows, "folds")
    figures = {} if callable(extra) else figures_without(rows, "fold", list(range(folds)), numeric, categorical, label)

    def one_fold(fold: int) -> list[DataFrame]:
        train, test = rows.filter(F.col("fold") != fold), rows.filter(F.col("fold") == fold)
        if callable(extra):
            train = train.select(*columns).unionByName(extra(train.select(*columns)).select(*columns))
        own = figures[fold] if figures else figures_of(train, numeric, categorical, label)
        preprocessor = preprocessor_of(own, train, categorical)
        weighted = train.withColumn("_weight", class_weight(own.labels, label)).withColumn("_class", class_index(label, classes))
        ready = written(preprocessor.transform(weighted).select("features", "_class", "_weight"), "training")
        prepared_test = preprocessor.transform(test)
        fitted = {name: estimator.fit(ready) for name, estimator in models(own.rows).items()}
        discard(ready)
        return [
            model.transform(prepared_test).select(
                F.lit(name).alias("model"), "fold", row_id, F.col(label).alias("actual"),
                class_name(F.col("prediction"), classes).alias("predicted"),
            )
            for name, model in fitted.items()
        ]

    with ThreadPoolExecutor(parallelism) as pool:
        results = [part for parts in pool.map(inheritable_thread_target(gold.sparkSession)(one_fold), range(folds)) for part in parts]
    predictions = written(reduce(DataFrame.unionByName, results), "out-of-fold")
    discard(rows)
    return predictions
