"""First row per key, conflicting keys, and the joins that use them."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarack.functions.text import stripped
from tamarack.operators.joins import left_lookup


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in ``order``.

    Catalyst turns the rank filter into a group limit that already runs before the shuffle, so a hot key
    sends at most one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def conflicting_keys(
    df: DataFrame, keys: list[str], label: str, usable_flag: str | None = None, name: str = "n_distinct_functions"
) -> DataFrame:
    """Keys with more than one distinct label; over all labels, or only over rows whose ``usable_flag`` is true."""
    rows = df.dropna(subset=keys)
    if usable_flag is not None:
        rows = rows.filter(F.col(usable_flag))
    return rows.groupBy(*keys).agg(F.count_distinct(F.col(label)).alias(name)).filter(F.col(name) > 1)


def without_keys(df: DataFrame, keys: list[str], excluded: DataFrame) -> DataFrame:
    """Anti join; rows with a null key match nothing and stay."""
    return df.join(excluded.select(*keys), keys, "left_anti")


def unlabelled_pool(rows: DataFrame, gold: DataFrame, keys: list[str]) -> DataFrame:
    return without_keys(rows, keys, gold)


def attach_labels(alleles: DataFrame, labels: DataFrame, keys: list[str]) -> DataFrame:
    """Left join: duplicate labels fan out, unmatched alleles stay with nulls. Names are trimmed on both sides."""
    def trimmed(df: DataFrame) -> DataFrame:
        types = dict(df.dtypes)
        return df.withColumns({key: stripped(F.col(key)) for key in keys if types[key] == "string"})

    return trimmed(alleles).join(trimmed(labels), keys, "left")


def settled_labels(
    crosswalk: DataFrame, keys: list[str], label: str, usable_flag: str, carried: str, order: list[str], strict: bool = False
) -> DataFrame:
    """One row per key that has exactly one distinct usable label, with the first ``carried`` value in ``order``.

    Conflict test, exclusion and first-per-key need the same grouping, so they share one aggregation with a
    map-side combine: smallest label = largest label means one label. ``strict`` looks for conflicts over all
    labels of a key, the default only over usable ones.
    """
    rows = crosswalk.dropna(subset=keys)
    if not strict:
        rows = rows.filter(F.col(usable_flag))
    first = F.struct(*order, F.col(carried).alias("_carried"), F.col(label).alias("_label"))
    grouped = rows.groupBy(*keys).agg(
        F.min(label).alias("_low"), F.max(label).alias("_high"), F.min(F.when(F.col(usable_flag), first)).alias("_first")
    )
    return grouped.filter("_first is not null and _low = _high").select(
        *keys, F.col("_first._carried").alias(carried), F.col("_first._label").alias(label)
    )


def lookup(rows: DataFrame, table: DataFrame, row_key: str, table_key: str) -> DataFrame:
    """Left lookup on one key; ``table`` holds each key once. Null keys match nothing."""
    return left_lookup(rows, table.withColumnRenamed(table_key, "_key"), {row_key: "_key"})
