"""Per-row, per-class feature attributions of a forest (path-dependent Shapley values).

For one leaf whose path tests features 1..d, feature k contributes
    value * (o_k - z_k) * integral over t in (0, 1) of product over j != k of (z_j (1 - t) + o_j t)
where o_j says whether the row passes every test on j and z_j is the share of training weight that does. The
product has degree d - 1, so a Gauss-Legendre rule with ceil(d / 2) nodes gives the Shapley sum exactly.

Rows that lie between the same thresholds take the same paths. A table is first counted by such cells, each cell is
worked once, whatever the number of its rows, and the rows take their cell's values by a join that no hot cell slows.
"""

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamarack.operators.features import class_name
from tamarack.operators.joins import attach
from tamarack.operators.reshape import class_arrays_to_rows
from tamarack.session import discard, shared_folder, ship_package, written

#: Levels of the trees that one plan walks before its frontier is written.
LEVELS = 8
#: Path entries (a feature of a leaf) that are shipped to the workers at once.
ENTRIES = 2_000_000


def leaf_paths(model, name: str = "forest") -> DataFrame:
    """(tree, leaf, feature, low, high, share, value), a row per leaf: range and training share of each feature on its path.

    The node table is the one the saved model holds. The trees are walked level by level, all nodes of a level at once.
    """
    spark = SparkSession.active()
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("_tree"), "nodeData.*").select("*", "split.*")
    weight = F.aggregate("impurityStats", F.lit(0.0), lambda total, x: total + x)
    flag = F.when(F.col("numCategories") == 2, 0.5).when(F.col("numCategories") >= 0, F.raise_error(F.lit("attributions need numeric or 0/1 features")).cast("double"))
    first = F.get("leftCategoriesOrThreshold", 0)
    nodes = saved.select(
        "_tree", F.col("id").alias("_id"), weight.alias("_weight"), F.transform("impurityStats", lambda x: x / weight).alias("_value"), "leftChild", "rightChild",
        F.col("featureIndex").alias("_feature"), F.coalesce(flag, first).alias("_cut"), ((F.col("numCategories") < 0) | (first == 0)).alias("_left_is_low"),
    )

    def step(entry: Column, low: Column, high: Column, share: Column) -> Column:
        return F.struct(entry.alias("feature"), low.alias("low"), high.alias("high"), share.alias("share"))

    def child(node: str, is_low: Column) -> Column:
        low, high = F.when(~is_low, F.col("_cut")).otherwise(float("-inf")), F.when(is_low, F.col("_cut")).otherwise(float("inf"))
        return F.struct("_path", F.col(node).alias("node"), step(F.col("_feature"), low, high, F.col("_weight")).alias("last"), F.lit(None).cast("array<double>").alias("value"), F.col("_leaf").alias("leaf"))

    # A row is a node to visit with the test that led to it, its share still the parent's weight, or a leaf (value).
    kind = "array<struct<feature:int,low:double,high:double,share:double>>"
    front = saved.select(
        F.col("_tree").alias("tree"), F.array().cast(kind).alias("path"), F.lit(0).alias("node"), F.lit(None).cast("struct<feature:int,low:double,high:double,share:double>").alias("last"),
        F.lit(None).cast("array<double>").alias("value"), F.lit(None).cast("int").alias("leaf"),
    ).distinct()
    for level in range(max(tree.depth for tree in model.trees) + 1):
        met = front.join(nodes, (F.col("tree") == F.col("_tree")) & (F.col("node") == F.col("_id")), "left")
        share, last = F.col("_weight") / F.col("last.share"), F.col("last")
        narrowed = F.transform("path", lambda p: F.when(
            p["feature"] == last["feature"], step(p["feature"], F.greatest(p["low"], last["low"]), F.least(p["high"], last["high"]), p["share"] * share)
        ).otherwise(p))
        tested = F.exists("path", lambda p: p["feature"] == last["feature"])
        longer = F.concat("path", F.array(step(last["feature"], last["low"], last["high"], share)))
        done = met.withColumn("_path", F.when(F.col("_id").isNull() | last.isNull(), F.col("path")).when(tested, narrowed).otherwise(longer))
        ended = F.struct("_path", F.lit(None).cast("int").alias("node"), F.lit(None).cast("struct<feature:int,low:double,high:double,share:double>").alias("last"), F.coalesce("value", "_value").alias("value"), F.coalesce("leaf", "_id").alias("leaf"))
        both = F.array(child("leftChild", F.col("_left_is_low")), child("rightChild", ~F.col("_left_is_low")))
        following = F.when(F.col("_id").isNull() | (F.col("leftChild") < 0), F.array(ended)).otherwise(both)
        front = done.withColumn("_leaf", F.lit(None).cast("int")).select("tree", F.inline(following)).withColumnRenamed("_path", "path")
        if level % LEVELS == LEVELS - 1:
            front = written(front, f"{name}-level")
    columns = [F.col(f"path.{c}").alias(c) for c in ("feature", "low", "high", "share")]
    return written(front.select("tree", "leaf", *columns, "value"), f"{name}-paths")


def _padded(rows: pd.DataFrame) -> dict[str, np.ndarray]:
    """Leaf arrays of equal width; a padding entry always passes with share 1 and so contributes nothing."""
    width = max(1, int(rows["feature"].str.len().max()))

    def pad(column: str, filler: float) -> np.ndarray:
        return np.array([list(v) + [filler] * (width - len(v)) for v in rows[column]], dtype="float64")

    return {
        "feature": pad("feature", 0).astype("int64"), "low": pad("low", -np.inf), "high": pad("high", np.inf),
        "share": pad("share", 1.0), "value": np.array(rows["value"].tolist(), dtype="float64"),
    }


def shapley(x: np.ndarray, leaves: dict[str, np.ndarray], block: int = 256) -> np.ndarray:
    """(rows, classes, features) sum over the given leaves, vectorised over rows and leaves."""
    features, classes = x.shape[1], leaves["value"].shape[1]
    width = leaves["feature"].shape[1]
    nodes, weights = np.polynomial.legendre.leggauss((width + 1) // 2)
    nodes, weights = (nodes + 1) / 2, weights / 2
    phi = np.zeros((len(x), features, classes))
    for first in range(0, len(leaves["feature"]), block):
        part = {key: array[first:first + block] for key, array in leaves.items()}
        at = x[:, part["feature"]]
        passes = ((at > part["low"]) & (at <= part["high"])).astype("float64")
        integral = np.zeros_like(passes)
        for t, w in zip(nodes, weights):
            factor = part["share"] * (1 - t) + passes * t
            integral += w * factor.prod(axis=2, keepdims=True) / factor
        effect = (passes - part["share"]) * integral
        for f in np.unique(part["feature"]):
            here = part["feature"] == f
            phi[:, f, :] += (effect * here).sum(axis=2) @ part["value"]
    return phi.transpose(0, 2, 1)


def cuts_of(paths: DataFrame) -> dict[int, list[float]]:
    """Per feature, all thresholds that a path compares it with, in order: fewer than the bins that training allows."""
    ends = F.flatten(F.transform(F.arrays_zip("feature", "low", "high"), lambda p: F.array(
        F.struct(p["feature"].alias("feature"), p["low"].alias("cut")), F.struct(p["feature"].alias("feature"), p["high"].alias("cut"))
    )))
    cuts = paths.select(F.inline(ends)).filter(F.abs("cut") < float("inf")).groupBy("feature").agg(F.array_sort(F.collect_set("cut")).alias("cuts"))
    return {row["feature"]: row["cuts"] for row in cuts.collect()}


def cell_of(x: Column, cuts: dict[int, list[float]]) -> Column:
    """How many thresholds of each tested feature lie below the row; -1 where it is not a number."""
    def place(value: Column, thresholds: list[float]) -> Column:
        below = F.filter(F.lit(np.asarray(thresholds, dtype="float64")), lambda cut: cut < value)
        return F.when(F.isnan(value), -1).otherwise(F.size(below))

    return F.array(*[place(F.get(x, feature), cuts[feature]) for feature in sorted(cuts)]).cast("array<int>")


def distinct_cells(x: np.ndarray, cuts: dict[int, list[float]]) -> tuple[np.ndarray, np.ndarray]:
    """The first row of each cell in a batch, and the cell of each row."""
    cells = np.column_stack([np.zeros(len(x), int), *[np.where(np.isnan(x[:, f]), -1, np.searchsorted(cuts[f], x[:, f])) for f in sorted(cuts)]])
    _, first, cell = np.unique(cells, axis=0, return_index=True, return_inverse=True)
    return first, cell.reshape(-1)


def _explained(cells: DataFrame, leaves: pd.DataFrame, trees: int) -> DataFrame:
    """``phi`` of the cells with what these leaves add to it."""
    groups = [_padded(group) for _, group in leaves.groupby(leaves["feature"].str.len())]
    shared = cells.sparkSession.sparkContext.broadcast(groups)
    names = cells.columns

    def work(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = np.array(batch["x"].to_pylist())
            parts = [sum(shapley(x[i:i + 128], group) for group in shared.value) / trees for i in range(0, len(x), 128)]
            phi = np.concatenate(parts).reshape(len(x), -1)
            before = batch["phi"].to_pylist()
            phi = [list(new if old is None else new + np.array(old)) for new, old in zip(phi, before)]
            columns = [pa.array(phi, pa.list_(pa.float64())) if name == "phi" else batch[name] for name in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return cells.mapInArrow(work, cells.schema)


def attributed_cells(df: DataFrame, paths: DataFrame, cuts: dict[int, list[float]] | None = None, features: str = "features") -> DataFrame:
    """(cell, n, x, phi): each cell between thresholds that has rows, its rows, one of their vectors, its attributions.

    Rows are counted by cell before the shuffle. Leaves go to the workers in blocks of a bounded number of path entries,
    one block after the other; attributions are sums over leaves, so each block adds its own.
    """
    ship_package(df.sparkSession)
    x = vector_to_array(features)
    cuts = cuts_of(paths) if cuts is None else cuts
    cells = df.select(cell_of(x, cuts).alias("cell"), x.alias("x")).groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("x"))
    cells = written(cells.withColumn("phi", F.lit(None).cast("array<double>")), "cells")
    size = paths.agg(F.sum(F.size("feature")).alias("entries"), F.count_distinct("tree").alias("trees")).first()
    blocks = max(1, -(-(size["entries"] or 0) // ENTRIES))
    for block in range(blocks):
        own = paths.filter(F.pmod(F.xxhash64("tree", "leaf"), F.lit(blocks)) == block) if blocks > 1 else paths
        before, cells = cells, written(_explained(cells, own.select("feature", "low", "high", "share", "value").toPandas(), size["trees"]), "cells")
        discard(before)
    return cells


def with_attributions(df: DataFrame, paths: DataFrame, features: str = "features", name: str = "phi") -> DataFrame:
    """Adds a class-major array of attributions, worked cell by cell over the whole table."""
    cuts = cuts_of(paths)
    cells = attributed_cells(df, paths, cuts, features)
    facts = cells.select(F.col("cell").alias("_cell"), F.col("n").alias("_n"), F.col("phi").alias("_phi"))
    total = cells.agg(F.sum("n")).first()[0] or 0
    placed = df.withColumn("_cell", cell_of(vector_to_array(features), cuts))
    met = attach(placed, facts, "_cell", "_n", total, F.spark_partition_id())
    return met.withColumn(name, F.col("_phi")).drop("_cell", "_n", "_phi")


def with_attributions_by_batch(df: DataFrame, paths: DataFrame, features: str = "features", name: str = "phi") -> DataFrame:
    """The same without a shuffle, for streams and uploads: each batch works each of its cells once. The leaf paths are broadcast, like the forest."""
    ship_package(df.sparkSession)
    leaves = paths.select("tree", "feature", "low", "high", "share", "value").toPandas()
    trees, cuts = leaves["tree"].nunique(), cuts_of(paths)
    shared = df.sparkSession.sparkContext.broadcast([_padded(group) for _, group in leaves.groupby(leaves["feature"].str.len())])

    @F.pandas_udf("array<double>")
    def explain(vectors: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in vectors:
            if not len(batch):
                yield pd.Series([], dtype=object)
                continue
            x = np.stack(batch.tolist())
            first, cell = distinct_cells(x, cuts)
            x = x[first]
            phi = np.concatenate([sum(shapley(x[s:s + 128], group) for group in shared.value) / trees for s in range(0, len(x), 128)])
            yield pd.Series(list(phi.reshape(len(x), -1)[cell]))

    return df.withColumn(name, explain(vector_to_array(features)))


def base_values(paths: DataFrame) -> DataFrame:
    """(class_index, base): the forest's expected probability of each class."""
    reach = F.aggregate("share", F.lit(1.0), lambda product, share: product * share)
    leaves = paths.select("tree", reach.alias("reach"), F.posexplode("value").alias("class_index", "value"))
    trees = paths.agg(F.count_distinct("tree").alias("trees")).first()["trees"]
    return leaves.groupBy("class_index").agg((F.sum(F.col("reach") * F.col("value")) / trees).alias("base"))


def mean_absolute(df: DataFrame, array: str, by: list[str] | None = None, weight: str | None = None) -> DataFrame:
    """(by..., mean_abs array): mean absolute value of each place of an array, without exploding the rows.

    ``weight`` says how many rows a row stands for.
    """
    by = by or []
    vector = array_to_vector(F.col(array).cast("array<double>"))
    stands_for = F.col(weight).cast("double") if weight else F.lit(1.0)
    summary = df.groupBy(*by).agg(Summarizer.metrics("normL1").summary(vector, stands_for).alias("_s"), F.sum(stands_for).alias("_rows"))
    total = vector_to_array("_s.normL1")
    return summary.select(*by, F.transform(total, lambda value: value / F.col("_rows")).alias("mean_abs"))


def importance_table(cells: DataFrame, classes: list[str], features: list[str], name: str = "mean_abs_shap") -> DataFrame:
    """(class, feature, mean |phi| over the rows) of attributed cells."""
    reduced = mean_absolute(cells, "phi", weight="n").withColumnRenamed("mean_abs", name)
    return class_arrays_to_rows(reduced, [], name, classes, features, name)


def overall_importance(table: DataFrame, value: str = "mean_abs_shap", by: list[str] | None = None) -> DataFrame:
    """Mean over classes."""
    return table.groupBy(*(by or []), "feature").agg(F.avg(value).alias(value))


def top_features(overall: DataFrame, k: int, value: str = "mean_abs_shap") -> DataFrame:
    return overall.orderBy(F.desc(value), "feature").limit(k)


def compare_importance(first: DataFrame, second: DataFrame, value: str = "mean_abs_shap") -> DataFrame:
    """(feature, phase1, phase2, rank1, rank2) of two overall tables; a feature may be in one only."""
    def ranked(table: DataFrame, phase: int) -> DataFrame:
        order = Window.partitionBy(F.lit(0)).orderBy(F.desc(value))  # one row per feature
        return table.select("feature", F.col(value).alias(f"phase{phase}"), F.rank().over(order).alias(f"rank{phase}"))

    return ranked(first, 1).join(ranked(second, 2), "feature", "full")


def top_feature(phi: Column, class_index: Column, features: list[str]) -> Column:
    """Name of the feature with the largest |phi| for the row's class; the first one wins ties."""
    own = F.transform(F.slice(phi, class_index * len(features) + 1, len(features)), F.abs)
    return class_name(F.array_position(own, F.array_max(own)) - 1, features)
