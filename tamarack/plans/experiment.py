"""Model comparison, self-training against the supervised baseline, attributions, outside scores."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.functions import vocab
from tamarack.functions.text import ordinal
from tamarack.operators.association import box_summary, correlations
from tamarack.operators.attribution import attributed_cells, compare_importance, importance_table, overall_importance
from tamarack.operators.features import sorted_classes
from tamarack.operators.filters import without_class
from tamarack.operators.metrics import confusion_counts, confusion_matrix, cv_summary
from tamarack.operators.models import model_set, random_forest
from tamarack.operators.scoring import Bundle, fit_bundle, with_impact_ordinal
from tamarack.operators.selftrain import Scorer, SelfTraining, forest_scorer, self_train
from tamarack.operators.validation import Models, out_of_fold_predictions
from tamarack.session import discard, written
from tamarack.sources.stages import write_table


@dataclass
class Setting:
    """Columns and sizes of one experiment; the defaults are the published ones."""

    row_id: str = "VariationID"
    label: str = "function_term"
    numeric: tuple[str, ...] = tuple(vocab.NUMERIC_FEATURES)
    categorical: str = vocab.CATEGORICAL_FEATURE
    folds: int = vocab.FOLDS
    seed: int = vocab.SEED
    trees: int = vocab.TREES
    depth: int = 30
    boost_rounds: int = vocab.TREES
    boost_depth: int = 6
    threshold: float = vocab.CONFIDENCE
    max_rounds: int = vocab.MAX_ROUNDS

    @property
    def features(self) -> list[str]:
        return [*self.numeric, self.categorical]


def training_rows(enriched: DataFrame) -> DataFrame:
    """Gold rows without the class too rare to cross-validate, with the impact as a number."""
    return with_impact_ordinal(without_class(enriched, "function_term", vocab.RARE_TERM))


def pool_rows(enriched: DataFrame) -> DataFrame:
    return with_impact_ordinal(enriched.filter(F.col(vocab.CATEGORICAL_FEATURE).isNotNull()))


def _predictions(gold: DataFrame, setting: Setting, classes: list[str], models, extra=None) -> DataFrame:
    return out_of_fold_predictions(
        gold, setting.row_id, setting.label, list(setting.numeric), setting.categorical, classes, models, setting.folds, setting.seed, extra
    )


def model_predictions(gold: DataFrame, setting: Setting, models: Models | None = None) -> DataFrame:
    """Every gold row once per classifier, predicted by the models of the other folds."""
    def published(n: int):
        return model_set(n, setting.trees, setting.depth, setting.boost_rounds, setting.boost_depth, setting.seed)
    return _predictions(gold, setting, sorted_classes(gold, setting.label), models or published)


def compare_models(gold: DataFrame, setting: Setting) -> DataFrame:
    """One row per classifier."""
    return cv_summary(model_predictions(gold, setting), "model", "fold", sorted_classes(gold, setting.label))


def train_iteratively(gold: DataFrame, pool: DataFrame, setting: Setting, scorer: Scorer | None = None) -> SelfTraining:
    """By the forest, or by another ``scorer``."""
    if scorer is None:
        classes = sorted_classes(gold, setting.label)
        scorer = forest_scorer(
            setting.label, list(setting.numeric), setting.categorical, classes, setting.trees, setting.depth, setting.seed
        )
    return self_train(gold, pool, setting.row_id, setting.label, setting.features, scorer, setting.threshold, setting.max_rounds)


@dataclass
class Phases:
    comparison: DataFrame
    confusion: DataFrame
    training: SelfTraining
    predictions: DataFrame  # out of fold, of both phases


def compare_phases(
    gold: DataFrame, pool: DataFrame, setting: Setting, nested: bool = False, scorer: Scorer | None = None,
    estimator: Callable[[], Estimator] | None = None,
) -> Phases:
    """Supervised baseline against self-training, both tested on gold rows only.

    The pseudo-labels come from all gold rows, test rows included, as published. ``nested`` derives them again
    inside every fold from that fold's training rows. Both phases share their out-of-fold tables between the
    metrics and the confusion matrix. ``scorer`` labels the pool and ``estimator`` is compared, a forest each if not given.
    """
    classes = sorted_classes(gold, setting.label)
    training = train_iteratively(gold, pool, setting, scorer)
    pseudo = training.pseudo
    estimator = estimator or (lambda: random_forest(setting.trees, setting.depth, setting.seed))

    def model(tag: str):
        return lambda n: {tag: estimator()}

    def extra(train: DataFrame) -> DataFrame:
        return train_iteratively(train, pool, setting, scorer).pseudo

    baseline = _predictions(gold, setting, classes, model(vocab.PHASES[0]))
    honest = _predictions(gold, setting, classes, model(vocab.PHASES[1]), extra if nested else pseudo)
    n_gold, n_pseudo = gold.count(), pseudo.count()
    predictions = baseline.unionByName(honest)
    both = cv_summary(predictions, "model", "fold", classes).withColumnRenamed("model", "tag")
    comparison = both.withColumns({
        "n_gold_labeled": F.lit(n_gold).cast("bigint"),
        "n_pseudo_labeled": F.when(F.col("tag").startswith("Phase2"), F.lit(n_pseudo)).otherwise(F.lit(0)).cast("bigint"),
    })
    return Phases(comparison, confusion_matrix(confusion_counts(honest, []), classes), training, predictions)


def final_bundle(labelled: DataFrame, setting: Setting, required: list[str], origin: str | None = None) -> Bundle:
    return fit_bundle(
        labelled, setting.label, list(setting.numeric), setting.categorical, required, setting.trees, setting.depth, setting.seed, origin
    )


def attribution_table(rows: DataFrame, bundle: Bundle) -> DataFrame:
    return importance_table(attributed_cells(bundle.pipeline.transform(rows), bundle.paths), bundle.classes, bundle.feature_names)


def compare_attributions(first: DataFrame, second: DataFrame) -> DataFrame:
    return compare_importance(overall_importance(first), overall_importance(second))


def write_experiment(out: str, gold: DataFrame, pool: DataFrame, setting: Setting) -> None:
    """Writes the results under ``out``: models and phases compared, the rounds of self-training and why they ended, and
    the attributions of the forest on gold rows and of the final one. The features of both tables are made once, for
    every fit, fold and round reads them again."""
    columns = [setting.row_id, *setting.features]
    gold, pool = written(gold.select(*columns, setting.label), "gold"), written(pool.select(*columns), "pool")
    write_table(compare_models(gold, setting), f"{out}/model_comparison", "csv")
    phases = compare_phases(gold, pool, setting)
    write_table(phases.comparison, f"{out}/phase_comparison", "csv")
    write_table(phases.training.log.withColumn("ended", F.lit(phases.training.ended)), f"{out}/iteration_log", "csv")
    rows = (gold, phases.training.labelled)
    bundles = (final_bundle(gold, setting, setting.features), final_bundle(rows[1], setting, setting.features, "origin"))
    tables = [attribution_table(r, b).withColumn("phase", F.lit(p)) for r, b, p in zip(rows, bundles, vocab.PHASES)]
    write_table(tables[0].drop("phase"), f"{out}/attributions", "csv")
    write_table(tables[0].unionByName(tables[1]), f"{out}/phase_attributions", "csv")
    bundles[1].save(f"{out}/bundle")
    discard(gold, pool)


def write_outside_scores(out: str, gold: DataFrame) -> None:
    """The gold rows with their outside scores, the correlations and the boxes."""
    table, boxes = outside_scores(gold)
    write_table(gold, f"{out}/outside_scores")
    write_table(table, f"{out}/correlations", "csv")
    write_table(boxes, f"{out}/boxes", "csv")


def outside_scores(gold: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rank correlations, box summary per score and class) of gold rows that carry the outside scores."""
    rows = without_class(gold, "function_term", vocab.RARE_TERM).withColumn(
        "function_ordinal", ordinal(F.col("function_term"), vocab.FUNCTION_ORDINAL)
    )
    scores = {"REVEL": "revel_score", "CADD": "cadd_phred"}
    boxes = [
        box_summary(rows.filter(F.col("function_ordinal").isNotNull()), column, "function_term").withColumn("score", F.lit(name))
        for name, column in scores.items()
    ]
    return correlations(rows, "function_ordinal", scores), boxes[0].unionByName(boxes[1])
