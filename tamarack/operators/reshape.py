"""Wide to long, arrays to rows, and long to wide with fixed columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_long(df: DataFrame, ids: list[str], columns: list[str], variable: str, value: str) -> DataFrame:
    """Unpivot without the empty cells."""
    return df.unpivot(ids, columns, variable, value).filter(F.col(value).isNotNull())


def class_arrays_to_rows(df: DataFrame, ids: list[str], array: str, classes: list[str], features: list[str], name: str) -> DataFrame:
    """A class-major array of numbers -> (ids..., class, feature, number)."""
    width = len(features)
    place = F.col("_place")
    return df.select(*ids, F.posexplode(array).alias("_place", name)).select(
        *ids,
        F.get(F.array(*[F.lit(c) for c in classes]), F.floor(place / width).cast("int")).alias("class"),
        F.get(F.array(*[F.lit(f) for f in features]), place % width).alias("feature"),
        name,
    )


def metric_columns(df: DataFrame, ids: list[str], key: str, value: str, keys: list[str], prefix: str) -> DataFrame:
    """One column per listed key, blanks in names replaced."""
    wide = df.groupBy(*ids).pivot(key, keys).agg(F.max(value))
    return wide.withColumnsRenamed({k: f"{prefix}{k.replace(' ', '_')}" for k in keys})
