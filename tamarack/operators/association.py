"""Rank correlation and per-class score distributions."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarack.functions.student import correlation_p
from tamarack.operators.quantiles import exact_quantiles
from tamarack.operators.ranks import pair_ranks
from tamarack.session import ROWS_PER_TASK, dealt, discard, written

#: A value in more than 1/HOT of the pairs is hot; there are fewer than HOT of them at any size. So with groups of rows.
HOT = 2000
#: Rows that a sample has of a group which is just hot.
SAMPLED_PER_GROUP = 200


def _large_groups(rows: DataFrame, by: list[str], total: int) -> DataFrame:
    """``by`` of about the groups with more than 1/HOT of the ``total`` rows, or with more than ``ROWS_PER_TASK``.

    They only spread the work, so of many rows a sample is enough to choose them.
    """
    limit = max(1.0, min(total / HOT, ROWS_PER_TASK))
    share = min(1.0, SAMPLED_PER_GROUP / limit)
    counts = rows.sample(share, seed=1).groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > share * limit).select(*by)


def _ranked_whole(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by..., w, dx, dy): centred ranks of groups that a task can hold. One shuffle by group serves all steps."""

    def centred(column: str) -> Column:
        order = Window.partitionBy(*by).orderBy(column)
        size = F.count(F.lit(1)).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        upto = F.count(F.lit(1)).over(order)  # with the ties
        return (F.rank().over(order) + upto - size - 1) / 2

    return rows.withColumn("dx", centred("x")).withColumn("dy", centred("y")).select(*by, F.lit(1).alias("w"), "dx", "dy")


def _sums(ranked: DataFrame, by: list[str]) -> DataFrame:
    dx, dy, w = F.col("dx"), F.col("dy"), F.col("w")
    return ranked.groupBy(*by).agg(
        F.sum("w").alias("n"), F.sum(w * dx * dy).alias("xy"), F.sum(w * dx * dx).alias("xx"), F.sum(w * dy * dy).alias("yy")
    )


def _with_rank(pairs: DataFrame, ranks: DataFrame, by: list[str], column: str, size: int) -> DataFrame:
    """``pairs`` with the centred rank of ``column`` as ``d<column>``.

    The ranks of hot values, as ordinals have, are broadcast; their rows go to the shuffled join under numbers of
    their own, so that they spread.
    """
    # Average ranks always have the mean (n + 1) / 2; centring first keeps the sums exact enough at any size.
    centred = F.col("avg_rank") - (F.col("_size") + 1) / 2
    keys = [*by, column]
    own = ranks.filter(F.col("axis") == column).select(*by, F.col("value").alias(column), centred.alias("_rank"), (F.col("k") * HOT > size).alias("_hot"))
    marked = pairs.join(F.broadcast(own.filter("_hot").select(*keys, F.col("_rank").alias("_known"))), keys, "left")
    spread = F.when(F.col("_known").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64("x", "y"), F.lit(1 << 30)))
    cold = own.filter("not _hot").select(*keys, "_rank", F.lit(0).cast("long").alias("_number"))
    met = marked.withColumn("_number", spread).join(cold, [*keys, "_number"], "left")
    return met.select(*pairs.columns, F.coalesce("_known", "_rank").alias(f"d{column}"))


def correlations_by(df: DataFrame, by: list[str], x: str, y: str, buckets: int | None = None) -> DataFrame:
    """(by..., n, rho, p) over the rows of each group where both columns have a value; fewer than three give nulls.

    The rows of small groups are shuffled once, to a task that ranks the whole group. Those of large groups, fewer than
    ``HOT`` or one per ``ROWS_PER_TASK``, are counted per distinct (x, y), so ties cost nothing after the map side; ranks
    and sums are made from the written counts. Tasks follow the number of rows, so each holds the same at any size.
    ``by`` must not be null.
    """
    rows = df.select(*by, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna(subset=["x", "y"])
    total = rows.count()
    keyless = reduce(or_, [F.col(c).isNull() for c in by], F.lit(False))
    with dealt(df.sparkSession, total):
        spread = rows
        if by:  # else all rows are one group
            large = F.broadcast(_large_groups(rows, by, total).withColumn("_large", F.lit(True)))
            spread = rows.join(large, by, "left").filter(F.col("_large") | keyless)  # rows without a key may be many too
        pairs = written(spread.groupBy(*by, "x", "y").agg(F.count(F.lit(1)).alias("w")), "pairs")
    size = pairs.count()
    with dealt(df.sparkSession, max(total, 2 * size)):  # a rank per pair and column
        ranks = written(pair_ranks(pairs, by, ["x", "y"], size, buckets), "ranks")
        ranked = _with_rank(_with_rank(pairs, ranks, by, "x", size), ranks, by, "y", size)
        sums = _sums(ranked, by)
        if by:  # The sample is not drawn again: the groups that pairs holds are the large ones.
            small = rows.filter(~keyless).join(F.broadcast(pairs.select(*by).distinct()), by, "left_anti")
            sums = sums.unionByName(_sums(_ranked_whole(small, by), by))
        sums = written(sums, "correlation-sums")
    discard(pairs, ranks)
    rho = F.try_divide(F.col("xy"), F.sqrt(F.col("xx")) * F.sqrt(F.col("yy")))
    kept = sums.select(*by, "n", F.when(F.col("n") >= 3, rho).alias("rho"))
    return kept.withColumn("p", correlation_p(F.col("rho"), F.col("n")))


def correlations(df: DataFrame, ordinal: str, scores: dict[str, str], buckets: int | None = None) -> DataFrame:
    """(score, n, rho, p), one row per score, from one scan; a score without values has n = 0."""
    given = F.array(*[F.struct(F.lit(name).alias("score"), F.col(column).cast("double").alias("x")) for name, column in scores.items()])
    long = df.select(F.col(ordinal).cast("double").alias("y"), F.inline(given))
    names = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, scores))).alias("score"))
    found = names.join(F.broadcast(correlations_by(long, ["score"], "x", "y", buckets)), "score", "left")  # a row per score
    return found.withColumn("n", F.coalesce("n", F.lit(0)))


def spearman(df: DataFrame, x: str, y: str, name: str, buckets: int | None = None) -> DataFrame:
    """(score, n, rho, p) of one pair of columns."""
    return correlations(df, y, {name: x}, buckets)


def box_summary(df: DataFrame, value: str, by: str, at_least: int = 3) -> DataFrame:
    """(by, n, lowest, q1, median, q3, highest, whisker_low, whisker_high) per class.

    Whiskers are the outermost values within 1.5 interquartile ranges of the box. With fewer than ``at_least``
    values over all classes there is no summary.
    """
    rows = df.filter(F.col(value).isNotNull() & F.col(by).isNotNull())
    quarters = exact_quantiles(rows, value, [0.0, 0.25, 0.5, 0.75, 1.0], [by])
    names = ["lowest", "q1", "median", "q3", "highest"]
    boxes = quarters.select(by, *[F.get("q", i).alias(name) for i, name in enumerate(names)])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    number = F.col(value).cast("double")
    inside = (number >= F.col("q1") - reach) & (number <= F.col("q3") + reach)
    # One row per class: broadcast, so that the rows are never dealt by a few class values.
    reduced = rows.join(F.broadcast(boxes), by).groupBy(by, *names).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(inside, number)).alias("whisker_low"),
        F.max(F.when(inside, number)).alias("whisker_high"),
    )
    enough = F.sum("n").over(Window.partitionBy(F.lit(0))) >= at_least  # one row per class
    kept = reduced.withColumn("_enough", enough).filter("_enough")
    return kept.select(by, "n", *names, "whisker_low", "whisker_high")
