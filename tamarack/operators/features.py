"""Feature preparation that is fitted on training rows only and saved as one ML pipeline."""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.operators.training import Figures, figures_of, number


@dataclass
class Preprocessor:
    """Numeric columns: median-filled and scaled by mean and population deviation. Categorical column: filled with
    its most frequent value and one-hot encoded; values unseen in training become all zeros."""

    model: PipelineModel
    feature_names: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)


def numeric_statistics(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float, float]]:
    """column -> (median, mean, deviation), the last two after filling with the median."""
    return figures_of(df.withColumn("_category", F.lit(None).cast("string")), columns, "_category").numeric


def scaled(column: str, median: float, mean: float, deviation: float) -> Column:
    return (F.coalesce(number(column), F.lit(median)) - F.lit(mean)) / F.lit(deviation)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def preprocessor_of(figures: Figures, columns: DataFrame, categorical: str) -> Preprocessor:
    """The preparation that the figures of training rows fix; of ``columns`` only the schema is used."""
    mode = figures.mode if figures.mode is not None else ""
    scaled_columns = [f"`num__{c}`" for c in figures.numeric]
    parts = [
        f"(coalesce(nanvl(double(`{c}`), null), double({median!r})) - double({mean!r})) / double({deviation!r}) AS {alias}"
        for alias, (c, (median, mean, deviation)) in zip(scaled_columns, figures.numeric.items())
    ]
    parts.append(f"coalesce(`{categorical}`, {_quoted(mode)}) AS `_filled`")
    fill = SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")
    # A model has a place for every category of its training rows, in order.
    index = StringIndexerModel.from_labels(figures.categories or [mode], "_filled", "_indexed", handleInvalid="keep")
    encode = OneHotEncoder(inputCols=["_indexed"], outputCols=["_encoded"], dropLast=True)
    names = [c.strip("`") for c in scaled_columns]
    assemble = VectorAssembler(inputCols=[*names, "_encoded"], outputCol="features")
    stages = [fill, index, encode.fit(index.transform(fill.transform(columns.limit(0)))), assemble]
    return Preprocessor(PipelineModel(stages), [*names, *[f"cat__{categorical}_{value}" for value in index.labels]])


def fit_preprocessor(df: DataFrame, numeric: list[str], categorical: str) -> Preprocessor:
    return preprocessor_of(figures_of(df, numeric, categorical), df, categorical)


def sorted_classes(df: DataFrame, label: str) -> list[str]:
    """The label vocabulary in sorted order; its positions are the class indices everywhere."""
    return sorted(row[0] for row in df.select(label).dropna().distinct().collect())  # as many as a model has classes


def class_index(label: str, classes: list[str]) -> Column:
    places = F.create_map(*[part for i, c in enumerate(classes) for part in (F.lit(c), F.lit(float(i)))])
    return F.try_element_at(places, F.col(label))


def class_name(index: Column, classes: list[str]) -> Column:
    return F.get(F.array(*[F.lit(c) for c in classes]), index.cast("int"))


def class_weight(labels: dict[str, int], label: str) -> Column:
    """Weight n / (k * n_c) as an expression of the class counts."""
    total = sum(labels.values())
    weights = [F.lit(part) for c, n in labels.items() for part in (c, total / (len(labels) * n))]
    return F.try_element_at(F.create_map(*weights), F.col(label))
