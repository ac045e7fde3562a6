"""What a model takes from its training rows besides the fit, for all folds from one scan.

Rows are counted by part (a fold, or rows that every fold trains on). The figures of the training rows of a fold are
those of all other parts: counts add, moments merge, and medians come from counts by (part, column, value) inside a
window that holds the median of every union of parts.
"""

from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarack.operators.quantiles import ACCURACY, value_at, window_shares, windowed_counts


@dataclass
class Figures:
    """Of some training rows."""

    numeric: dict[str, tuple[float, float, float]]  # column -> median, then mean and population deviation when filled with it
    categories: list[str]  # in order
    mode: str | None  # the most frequent category, ties to the smallest
    labels: dict[str, int]

    @property
    def rows(self) -> int:
        return sum(self.labels.values())


def number(column: str):
    """Numeric column with NaN read as missing."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def _merged(moments: list[tuple[int, float, float]]) -> tuple[int, float, float]:
    """Count, mean and sum of squared deviations of the union."""
    n, mean, square = 0, 0.0, 0.0
    for more, other, spread in moments:
        if more:
            gap, total = other - mean, n + more
            mean, square, n = mean + gap * more / total, square + spread + gap * gap * n * more / total, total
    return n, mean, square


def _medians(rows: DataFrame, part: str, left_out: list, columns: list[str], windows: list[tuple[float, float]], sizes: dict) -> dict:
    """(left out part, column) -> median of the other parts' values. The windows' rows are counted by part and value."""
    if not columns:
        return {}
    def entries(i: int, column: str, window: tuple[float, float]):
        counted = windowed_counts(number(column), [(F.lit(window[0]), F.lit(window[1]))])
        return F.transform(counted, lambda e: F.struct(F.lit(i).alias("i"), e["below"].alias("below"), e["value"].alias("value")))

    wide = F.concat(*[entries(i, c, w) for i, (c, w) in enumerate(zip(columns, windows))])
    counts = rows.select(part, F.inline(wide)).groupBy(part, "i", "below", "value").agg(F.count(F.lit(1)).alias("n"))
    others = [F.sum(F.when(~F.col(part).eqNullSafe(F.lit(f)), F.col("n")).otherwise(0)).alias(f"n{k}") for k, f in enumerate(left_out)]
    order = Window.partitionBy("i").orderBy(F.desc("below"), "value")  # the rows of one window
    running = counts.groupBy("i", "below", "value").agg(*others).select("*", *[F.sum(f"n{k}").over(order).alias(f"upto{k}") for k in range(len(left_out))])
    wanted = []
    for k, f in enumerate(left_out):
        size = F.get(F.array(*[F.lit(sizes[f, c]) for c in columns]), F.col("i"))
        for name, place in (("low", F.floor((size - 1) / 2)), ("high", F.ceil((size - 1) / 2))):
            wanted.append(value_at(place, F.col(f"upto{k}"), F.col(f"n{k}")).alias(f"{name}{k}"))
    found = {}
    for row in running.groupBy("i").agg(*wanted).collect():  # one row per column
        for k, f in enumerate(left_out):
            if sizes[f, columns[row["i"]]]:
                found[f, columns[row["i"]]] = (row[f"low{k}"] + row[f"high{k}"]) / 2
    return found


def figures_without(rows: DataFrame, part: str, left_out: list, numeric: list[str], categorical: str, label: str, accuracy: int = ACCURACY) -> dict:
    """For each part of ``left_out`` the figures of the rows of all other parts; for ``None``, of all rows.

    ``part`` must not be null. One pass sketches and counts, a second counts the windows' values. The driver sees a row
    per part and a row per (part, label, category).
    """
    ends = list(window_shares(0.5, accuracy))
    shape = [f(number(c)).alias(f"{name}_{i}") for i, c in enumerate(numeric) for name, f in (("n", F.count), ("mean", F.avg), ("var", F.var_pop))]
    sketch = [F.percentile_approx(number(c), ends, accuracy).alias(f"ends_{i}") for i, c in enumerate(numeric)]
    wanted = [
        rows.groupBy(part).agg(F.count(F.lit(1)).alias("rows"), *shape, *sketch),
        rows.groupBy(part, F.col(label).alias("label"), F.col(categorical).alias("category")).agg(F.count(F.lit(1)).alias("n")),
    ]
    with ThreadPoolExecutor(2) as pool:  # two small results, asked for at once
        of_parts, kinds = pool.map(inheritable_thread_target(rows.sparkSession)(DataFrame.collect), wanted)
    per_part = {r[part]: r for r in of_parts}
    held = {i: [r[f"ends_{i}"] for r in per_part.values() if r[f"ends_{i}"] is not None] for i in range(len(numeric))}
    some = [i for i in held if held[i]]
    others = {f: [r for p, r in per_part.items() if p != f or f is None] for f in left_out}
    sizes = {(f, c): sum(r[f"n_{i}"] for r in others[f]) for f in left_out for i, c in enumerate(numeric)}
    windows = [(min(e[0] for e in held[i]), max(e[1] for e in held[i])) for i in some]
    medians = _medians(rows, part, left_out, [numeric[i] for i in some], windows, sizes)

    out = {}
    for f in left_out:
        figures = {}
        for i, c in enumerate(numeric):
            median = medians.get((f, c), 0.0)
            missing = sum(r["rows"] - r[f"n_{i}"] for r in others[f])
            parts = [(r[f"n_{i}"], r[f"mean_{i}"] or 0.0, (r[f"var_{i}"] or 0.0) * r[f"n_{i}"]) for r in others[f]]
            n, mean, square = _merged([*parts, (missing, median, 0.0)])
            figures[c] = (median, mean, (square / n) ** 0.5 or 1.0 if n else 1.0)
        labels, categories = Counter(), Counter()
        for r in kinds:
            if r[part] != f or f is None:
                labels[r["label"]] += r["n"]
                if r["category"] is not None:
                    categories[r["category"]] += r["n"]
        mode = min(categories, key=lambda c: (-categories[c], c), default=None)
        out[f] = Figures(figures, sorted(categories), mode, dict(labels))
    return out


def figures_of(rows: DataFrame, numeric: list[str], categorical: str, label: str | None = None) -> Figures:
    """Of all rows."""
    labelled = rows.withColumn("_part", F.lit(0))
    name = label or "_label"
    return figures_without(labelled if label else labelled.withColumn(name, F.lit("")), "_part", [None], numeric, categorical, name)[None]
