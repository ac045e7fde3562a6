"""Exact order statistics from two scans and without ordering a column.

The first scan keeps a mergeable sketch per group, whose quantiles enclose each wanted place in a window of a few rows
in ten thousand (all rows of a small group). The second counts the rows below the window and the values inside; only those are ordered. A place that
its window does not hold would be an error of the sketch and raises one, so no answer is an approximation.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarack.session import written

#: A sketch's ranks are off by 1 / ACCURACY of the rows at most; a window reaches MARGIN as far to either side.
ACCURACY = 20_000
MARGIN = 3.0


def numbers(df: DataFrame, by: list[str], value: str) -> DataFrame:
    return df.select(*by, F.col(value).cast("double").alias("value")).filter("value is not null and not isnan(value)")


def window_shares(share: float, accuracy: int) -> tuple[float, float]:
    return max(0.0, share - MARGIN / accuracy), min(1.0, share + MARGIN / accuracy)


def windowed_counts(value: Column, windows: list[tuple[Column, Column]]) -> Column:
    """Array of (i, below, value) for the windows that hold the value (``below`` false) or lie above it (value null)."""
    entries = [
        F.struct(F.lit(i).alias("i"), (value < low).alias("below"), F.when(value >= low, value).alias("value"), (value <= high).alias("counts"))
        for i, (low, high) in enumerate(windows)
    ]
    return F.filter(F.array(*entries), lambda entry: entry["counts"])


def value_at(place: Column, upto: Column, n: Column) -> Column:
    """Aggregate: the value that holds a place, counted from 0, among rows (below, value) with running counts."""
    holds = ~F.col("below") & (place < upto) & (place >= upto - n)
    return F.max(F.when(holds, F.col("value")))


def exact_quantiles(df: DataFrame, value: str, shares: list[float], by: list[str] | None = None, accuracy: int = ACCURACY) -> DataFrame:
    """(by..., q array): linearly interpolated quantiles of the non-null values, exact at any size.

    ``by`` must not be null; a group without values has no row.
    """
    by = by or []
    rows = numbers(df, by, value)
    ends = [end for share in shares for end in window_shares(share, accuracy)]
    sketches = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_size"), F.percentile_approx("value", ends, accuracy).alias("_ends"))
    # One row per group, written, so that its size decides how it is joined: rows are not dealt by a few classes.
    windows = written(sketches.filter("_size > 0"), "windows")
    placed = rows.join(windows, by) if by else rows.crossJoin(F.broadcast(windows))  # one row
    small = F.col("_size") <= accuracy  # where a margin may be less than one row
    places = [
        (F.when(small, float("-inf")).otherwise(F.get("_ends", 2 * i)), F.when(small, float("inf")).otherwise(F.get("_ends", 2 * i + 1)))
        for i in range(len(shares))
    ]
    entries = placed.select(*by, "_size", F.inline(windowed_counts(F.col("value"), places)))
    counts = entries.groupBy(*by, "_size", "i", "below", "value").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(*by, "i").orderBy(F.desc("below"), "value")  # the rows of one window
    running = counts.withColumn("upto", F.sum("n").over(order))
    between = (F.col("_size") - 1) * F.get(F.array(*[F.lit(float(s)) for s in shares]), F.col("i"))
    found = running.withColumn("_between", between).groupBy(*by, "i", "_between").agg(
        value_at(F.floor("_between"), F.col("upto"), F.col("n")).alias("low"), value_at(F.ceil("_between"), F.col("upto"), F.col("n")).alias("high"),
    )
    exact = F.col("low") + (F.col("high") - F.col("low")) * (F.col("_between") - F.floor("_between"))
    checked = F.coalesce(exact, F.raise_error(F.lit("a quantile lies outside the window of its sketch")).cast("double"))
    listed = found.groupBy(*by, F.lit(0).alias("_one")).agg(F.array_sort(F.collect_list(F.struct("i", checked.alias("q")))).alias("q"))  # one entry per share
    return listed.select(*by, F.transform("q", lambda entry: entry["q"]).alias("q"))


def exact_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, median) of several numeric columns; a column without values is left out."""
    narrow = df.select([F.col(column).cast("double").alias(column) for column in columns])
    long = narrow.unpivot([], columns, "column", "value")
    return exact_quantiles(long, "value", [0.5], ["column"]).select("column", F.get("q", 0).alias("median"))
