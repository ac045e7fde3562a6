"""Counts, coverage and per-class summaries."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def rows_and_distinct(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(column).alias("n_distinct"))


def label_availability(df: DataFrame, by: list[str], usable_flag: str) -> DataFrame:
    """Total, usable and excluded labels per group."""
    total, usable = F.count(usable_flag), F.coalesce(F.sum(F.col(usable_flag).cast("int")), F.lit(0))
    return df.groupBy(*by).agg(total.alias("total"), usable.alias("usable"), (total - usable).alias("excluded"))


def value_counts(df: DataFrame, columns: list[str], name: str = "n") -> DataFrame:
    """Counts of non-null values, most frequent first, ties by value."""
    counts = df.dropna(subset=columns).groupBy(*columns).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.desc(name), *columns)


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """One pass: how many rows carry each column, as (column, n_present, n_total)."""
    counted = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count(column).alias(column) for column in columns])
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_present")) for c in columns])
    return counted.select("_total", F.inline(entries)).select("column", "n_present", F.col("_total").alias("n_total"))


def terms_seen(df: DataFrame, by: list[str], term: str) -> DataFrame:
    """The distinct terms of each group as rows (null included), so no group's set has to fit in one cell."""
    return df.select(*by, term).distinct()


def listed(spark: SparkSession, values: list[str], name: str) -> DataFrame:
    """A given short list as a one-column table."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(value) for value in values])).alias(name))


def counts_for_classes(df: DataFrame, predicted: str, classes: list[str], name: str = "n") -> DataFrame:
    """Count of each listed class, 0 for the absent ones."""
    counted = df.filter(F.col(predicted).isin(classes)).groupBy(predicted).agg(F.count(F.lit(1)).alias(name))
    return listed(df.sparkSession, classes, predicted).join(counted, predicted, "left").fillna(0, [name])


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k * n_c) of each class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    over_classes = Window.partitionBy(F.lit(0))  # one row per class
    total, classes = F.sum("n").over(over_classes), F.count(F.lit(1)).over(over_classes)
    return counts.withColumn("weight", total / (classes * F.col("n")))


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value; ties go to the smallest."""
    return value_counts(df, [column], "n").limit(1)
