"""Ranks and folds without a window over a whole column or a whole class.

Every operator here cuts its ordering into buckets that respect the order, works inside buckets, and shifts each
bucket by the total of the buckets before it. Only the bucket totals, at most one row per (group, bucket), are
ordered in one place.
"""

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarack.operators.quantiles import numbers

ROWS_PER_BUCKET = 1_000_000
SAMPLED_PER_BUCKET = 200


def _value_buckets(rows: int) -> int:
    """A power of two that keeps a bucket to about ``ROWS_PER_BUCKET``, at any size."""
    return max(64, 1 << math.ceil(math.log2(max(rows, 1) / ROWS_PER_BUCKET + 1)))


def _hash_digits(rows: int) -> int:
    """Hexadecimal digits that keep a bucket to about ``ROWS_PER_BUCKET``."""
    return max(2, math.ceil(math.log(max(rows, 1) / ROWS_PER_BUCKET + 1, 16)))


def _bucket_shifts(df: DataFrame, by: list[str], bucket: str, weight: Column) -> DataFrame:
    """(by..., bucket, _total, _shift, _size): weight of the bucket, of the buckets before it, and of the group."""
    totals = df.groupBy(*by, bucket).agg(F.sum(weight).alias("_total"))
    group = Window.partitionBy(*by, F.lit(0))
    earlier = group.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumns({
        "_shift": F.coalesce(F.sum("_total").over(earlier), F.lit(0)), "_size": F.sum("_total").over(group),
    })


def _inside_before(by: list[str], bucket: str, order: list[Column], weight: Column) -> Column:
    """Weight of the rows before this one in its bucket."""
    inside = Window.partitionBy(*by, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(weight).over(inside), F.lit(0))


def _weight_before(df: DataFrame, by: list[str], bucket: str, order: list[Column], weight: Column, name: str) -> DataFrame:
    """Adds the total weight of the rows that come before each row of its group, and ``_size``, the group's weight.

    ``by`` must not be null.
    """
    shifts = _bucket_shifts(df, by, bucket, weight).select(*by, bucket, "_shift", "_size")
    placed = df.withColumn("_inside", _inside_before(by, bucket, order, weight))
    return placed.join(shifts, [*by, bucket]).withColumn(name, F.col("_shift") + F.col("_inside")).drop("_shift", "_inside")


def _bucket_of(value: Column, bounds: list[float]) -> Column:
    """Number of bounds at or below the value, by binary search; as many bounds as a power of two less one."""
    table = F.lit(np.asarray(bounds, dtype="float64"))
    steps, step = [], (len(bounds) + 1) // 2
    while step:
        steps.append(F.lit(step))
        step //= 2

    def advance(found: Column, jump: Column) -> Column:
        return F.when(F.get(table, found + jump - 1) <= value, found + jump).otherwise(found)

    return F.aggregate(F.array(*steps), F.lit(0), advance)


def _value_bounds(rows: DataFrame, columns: list[str], size: int, buckets: int | None) -> list[list[float]]:
    """Bounds that cut each column into buckets of about the same size.

    They only spread the work, like those of a range partitioner, so a sample is enough to choose them.
    """
    buckets = buckets or _value_buckets(size)
    share = min(1.0, SAMPLED_PER_BUCKET * buckets / max(size, 1))
    shares = [i / buckets for i in range(1, buckets)]
    found = rows.sample(share, seed=1).approxQuantile(columns, shares, 0.5 / buckets)
    return [bounds or [0.0] * len(shares) for bounds in found]


def _bucketed(counts: DataFrame, by: list[str], bounds: list[float] | dict[str, list[float]]) -> DataFrame:
    """Adds the bucket to a table of one row per (by..., value). The bounds, one list or one per axis, are fixed numbers."""
    # Aggregated once more by the same keys, which shuffles nothing: so the bucket is a result, not an expression of
    # the value, which the optimizer would push down to every raw row or look for where the value is gone.
    others = [F.max(c).alias(c) for c in counts.columns if c not in (*by, "value")]
    value = F.col("value")
    if isinstance(bounds, dict):
        bucket = F.coalesce(*[F.when(F.col("axis") == axis, _bucket_of(value, limits)) for axis, limits in bounds.items()])
    else:
        bucket = _bucket_of(value, bounds)
    found = counts.groupBy(*by, "value").agg(*others, F.max(bucket).alias("bucket"))
    return found.withColumn("bucket", F.coalesce("bucket", F.lit(0)))


def _distinct_values(rows: DataFrame, by: list[str], size: int, buckets: int | None) -> DataFrame:
    """(by..., value, n, bucket) over distinct values."""
    bounds = _value_bounds(rows, ["value"], size, buckets)[0]
    return _bucketed(rows.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n")), by, bounds)


def _ranked(counts: DataFrame, by: list[str]) -> DataFrame:
    """Adds avg_rank, the mean of the ranks that ``n`` tied values share, and ``_size`` to bucketed counts."""
    placed = _weight_before(counts, by, "bucket", [F.col("value")], F.col("n"), "below")
    return placed.withColumn("avg_rank", F.col("below") + (F.col("n") + 1) / 2).drop("below", "bucket")


def average_ranks(df: DataFrame, value: str, by: list[str] | None = None, buckets: int | None = None) -> DataFrame:
    """(by..., value, n, avg_rank): the mean of the ranks that tied values share."""
    by = by or []
    return _ranked(_distinct_values(numbers(df, by, value), by, df.count(), buckets), by).select(*by, "value", "n", "avg_rank")


def pair_ranks(pairs: DataFrame, by: list[str], columns: list[str], size: int, buckets: int | None = None) -> DataFrame:
    """(by..., axis, value, n, k, avg_rank, _size): the ranks of each of ``columns``, which ``axis`` names.

    ``pairs`` holds ``size`` distinct rows that count ``w`` each; ``k`` of them hold the value, and ``_size`` is the
    group's weight.
    """
    bounds = dict(zip(columns, _value_bounds(pairs, columns, size, buckets)))
    axes = F.array(*[F.struct(F.lit(c).alias("axis"), F.col(c).alias("value")) for c in columns])
    counts = pairs.select(*by, "w", F.inline(axes)).groupBy(*by, "axis", "value").agg(F.sum("w").alias("n"), F.count(F.lit(1)).alias("k"))
    return _ranked(_bucketed(counts, [*by, "axis"], bounds), [*by, "axis"])


def stratified_folds(df: DataFrame, row_id: str, label: str, folds: int = 5, seed: int = 42, digits: int | None = None) -> DataFrame:
    """Adds ``fold`` (0 .. folds - 1): each class is dealt out in turn, in the order of a seeded hash of the row id.

    The leading digits of the hash are the buckets, so even one class that holds most rows spreads evenly.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}-"), F.col(row_id).cast("string")))
    digits = digits or _hash_digits(df.count())
    hashed = df.filter(F.col(label).isNotNull()).withColumn("_digest", digest).withColumn(
        "_bucket", F.substring("_digest", 1, digits)
    )
    placed = _weight_before(hashed, [label], "_bucket", [F.col("_digest"), F.col(row_id)], F.lit(1), "_place")
    return placed.withColumn("fold", (F.col("_place") % folds).cast("int")).drop("_digest", "_bucket", "_place", "_size")
