"""The saved bundle, and batch or streaming scoring with it."""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.functions import vocab
from tamarack.functions.text import one_decimal_percent, ordinal, plain_feature, short_name, whole_percent
from tamarack.operators.attribution import leaf_paths, top_feature, with_attributions, with_attributions_by_batch
from tamarack.operators.features import class_index, class_weight, preprocessor_of
from tamarack.operators.filters import require_columns
from tamarack.operators.models import random_forest, with_top_class
from tamarack.operators.training import figures_of
from tamarack.sources.stages import is_complete


@dataclass
class Bundle:
    """Preprocessor and forest in one pipeline, the forest's leaf paths, and what is needed to read the results."""

    pipeline: PipelineModel
    paths: DataFrame
    classes: list[str]
    feature_names: list[str]
    required: list[str]
    categorical: str
    n_gold: int
    n_pseudo: int

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/model")
        self.paths.write.mode("overwrite").parquet(f"{path}/paths")
        schema = (
            "classes array<string>, feature_names array<string>, required array<string>, categorical string, "
            "training_n_gold bigint, training_n_pseudo bigint, training_n_total bigint"
        )
        row = (self.classes, self.feature_names, self.required, self.categorical, self.n_gold, self.n_pseudo, self.n_gold + self.n_pseudo)
        self.paths.sparkSession.createDataFrame([row], schema).write.mode("overwrite").parquet(f"{path}/metadata")


def load_bundle(spark: SparkSession, path: str) -> Bundle | None:
    """The saved bundle, or None when there is none."""
    if not is_complete(spark, f"{path}/metadata"):
        return None
    row = spark.read.parquet(f"{path}/metadata").first()
    return Bundle(
        PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/paths"), list(row["classes"]), list(row["feature_names"]),
        list(row["required"]), row["categorical"], row["training_n_gold"], row["training_n_pseudo"],
    )


def fit_bundle(
    labelled: DataFrame, label: str, numeric: list[str], categorical: str, required: list[str],
    trees: int = vocab.TREES, depth: int = 30, seed: int = vocab.SEED, origin: str | None = None,
) -> Bundle:
    """Final fit on all labelled rows (gold, or gold and pseudo-labelled)."""
    figures = figures_of(labelled.filter(F.col(label).isNotNull()), numeric, categorical, label)
    classes = sorted(figures.labels)
    preprocessor = preprocessor_of(figures, labelled, categorical)
    weighted = labelled.withColumn("_weight", class_weight(figures.labels, label)).withColumn("_class", class_index(label, classes))
    forest = random_forest(trees, depth, seed).fit(preprocessor.transform(weighted))
    pseudo = F.col(origin) == "pseudo" if origin else F.lit(False)
    counts = labelled.agg(F.count(F.lit(1)).alias("n"), F.count_if(pseudo).alias("p")).first()
    return Bundle(
        PipelineModel([*preprocessor.model.stages, forest]), leaf_paths(forest), classes, preprocessor.feature_names, required,
        categorical, counts["n"] - counts["p"], counts["p"],
    )


def with_impact_ordinal(df: DataFrame) -> DataFrame:
    return df.withColumn("vep_impact_ordinal", ordinal(F.col("vep_impact"), vocab.IMPACT_ORDINAL))


def score(df: DataFrame, bundle: Bundle, prepare=with_impact_ordinal, by_cell: bool = False) -> DataFrame:
    """Input columns plus ``_pred_class``, ``_confidence`` and ``_top_feature``.

    No shuffle, and works on a stream; ``by_cell`` is for large tables, whose rows repeat the model's cells.
    """
    prepared = prepare(require_columns(df, bundle.required))
    scored = with_top_class(bundle.pipeline.transform(prepared), bundle.classes)
    explained = (with_attributions if by_cell else with_attributions_by_batch)(scored, bundle.paths)
    name = top_feature(F.col("phi"), F.col("_pred_index"), bundle.feature_names)
    return explained.withColumn("_top_feature", plain_feature(name, bundle.categorical)).select(
        *prepared.columns, "_pred_class", "_confidence", "_top_feature"
    )


def explain(df: DataFrame, bundle: Bundle) -> DataFrame:
    """Rows with ``features`` and the class-major attribution array ``phi``."""
    return with_attributions(bundle.pipeline.transform(df), bundle.paths)


def prediction_table(scored: DataFrame) -> DataFrame:
    """Published column names, without the helper column."""
    return scored.drop("vep_impact_ordinal").withColumnsRenamed(vocab.OUTPUT_NAMES)


def display_columns(name: Column, confidence: Column) -> dict[str, Column]:
    return {"short_name": short_name(name), "confidence_text": one_decimal_percent(confidence), "bar_width": whole_percent(confidence)}
