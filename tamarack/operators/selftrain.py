"""Iterative self-training: fit, score the pool, move the confident rows over, repeat.

The pool is written once, with a number for each row. A round leaves a table of row numbers, labels and whether they were
taken, then one line in the log; features are never written again. A driver that starts over on the same folder reads the
log and goes on after its last line.
"""

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.functions.vocab import CONFIDENCE, MAX_ROUNDS, SEED, TREES
from tamarack.operators.features import class_index, class_weight, preprocessor_of
from tamarack.operators.models import random_forest, top_class, with_top_class
from tamarack.operators.training import figures_of
from tamarack.session import discard, shared_folder, written
from tamarack.sources.stages import is_complete, write_table

Scorer = Callable[[DataFrame], Callable[[DataFrame], DataFrame]]
LOG_SCHEMA = (
    "iteration int, n_pseudo_added bigint, n_total_labeled bigint, n_remaining_unlabeled bigint, pseudo_label_dist string"
)


@dataclass
class SelfTraining:
    labelled: DataFrame  # gold and pseudo rows; ``origin`` tells them apart, ``round`` is 0 for gold
    remaining: DataFrame
    log: DataFrame
    ended: str  # why the rounds ended: "none confident", "pool empty" or "last round"

    @property
    def pseudo(self) -> DataFrame:
        return self.labelled.filter("origin = 'pseudo'")


class Rounds:
    """What the rounds of one self-training have left in its folder."""

    def __init__(self, folder: str, gold: DataFrame, pool: DataFrame, label: str):
        self.spark, self.folder, self.label = gold.sparkSession, folder, label
        self.kind = gold.schema[label].dataType.simpleString()
        for name, rows in (("gold", gold), ("pool", pool.withColumn("_row", F.monotonically_increasing_id()))):
            if not is_complete(self.spark, f"{folder}/{name}"):
                write_table(rows, f"{folder}/{name}")
        self.gold, self.pool = (self.spark.read.parquet(f"{folder}/{name}") for name in ("gold", "pool"))

    def log(self) -> list[tuple]:
        """The finished rounds, in order. A line is written after its round's table, so the table is whole."""
        if not is_complete(self.spark, f"{self.folder}/log"):
            return []
        return sorted(tuple(row) for row in self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.folder}/log").collect())

    def finish(self, line: tuple) -> None:
        values = [F.lit(value).cast(kind).alias(name) for value, (name, kind) in zip(line, (field.split() for field in LOG_SCHEMA.split(", ")))]
        self.spark.range(1, numPartitions=1).select(*values).write.mode("append").parquet(f"{self.folder}/log")

    def table(self, number: int) -> DataFrame:
        return self.spark.read.schema(f"_row bigint, {self.label} {self.kind}, _taken boolean").parquet(f"{self.folder}/round-{number}")

    def write(self, number: int, scored: DataFrame) -> DataFrame:
        """A table that an earlier driver left without a line in the log is written again."""
        write_table(scored.select("_row", self.label, "_taken"), f"{self.folder}/round-{number}")
        return self.table(number)

    def known(self, upto: int) -> DataFrame:
        """The pool with the label and the round of the rows taken so far, null for the others."""
        taken = self.spark.createDataFrame([], f"_row bigint, {self.label} {self.kind}, round int")
        for number in range(1, upto + 1):
            taken = taken.unionAll(self.table(number).filter("_taken").select("_row", self.label, F.lit(number).alias("round")))
        return self.pool.join(taken, "_row", "left")

    def labelled(self, upto: int, columns: list[str]) -> DataFrame:
        gold = self.gold.select(*columns, F.lit("gold").alias("origin"), F.lit(0).alias("round"))
        if not upto:
            return gold
        return gold.unionByName(self.known(upto).filter("round is not null").select(*columns, F.lit("pseudo").alias("origin"), "round"))


def self_train(
    gold: DataFrame, pool: DataFrame, row_id: str, label: str, features: list[str], scorer: Scorer,
    threshold: float = CONFIDENCE, max_rounds: int = MAX_ROUNDS, folder: str | None = None,
) -> SelfTraining:
    """The rounds, under ``folder`` (shared; a new one if not given). Row ids need not be unique.

    Nothing recomputes an earlier round, even after losing executors or the driver.
    """
    columns = [row_id, *features, label]
    rounds = Rounds(folder or f"{shared_folder(gold.sparkSession)}/self-training-{uuid.uuid4().hex}", gold.select(*columns), pool.select(row_id, *features), label)
    log, ended = rounds.log(), "last round"
    total = log[-1][2] if log else rounds.gold.count()
    if log and log[-1][3] == 0:
        ended = "pool empty"
    for number in range(len(log) + 1, max_rounds + 1):
        if ended == "pool empty":
            break
        done = number - 1
        labelled = written(rounds.labelled(done, columns), "labelled") if done else rounds.labelled(0, columns)
        score = scorer(labelled)
        remaining = rounds.known(done).filter("round is null").drop(label, "round") if done else rounds.pool
        taken = F.coalesce(F.col("_confidence") >= threshold, F.lit(False))
        scored = rounds.write(number, score(remaining).select("_row", F.col("_pred_class").alias(label), taken.alias("_taken")))
        if done:
            discard(labelled)
        # At most two rows per class.
        counts = scored.groupBy("_taken", label).count().collect()
        added = {row[label]: row["count"] for row in counts if row["_taken"]}
        if not added:
            ended = "none confident" if counts else "pool empty"
            break
        total += sum(added.values())
        left = sum(row["count"] for row in counts if not row["_taken"])
        ordered = dict(sorted(added.items(), key=lambda item: (-item[1], item[0])))
        log.append((number, sum(added.values()), total, left, str(ordered)))
        rounds.finish(log[-1])
        if left == 0:
            ended = "pool empty"
    labelled = written(rounds.labelled(len(log), columns), "labelled")
    remaining = rounds.known(len(log)).filter("round is null") if log else rounds.pool
    return SelfTraining(labelled, remaining.select(row_id, *features), gold.sparkSession.createDataFrame(log, LOG_SCHEMA), ended)


def forest_scorer(
    label: str, numeric: list[str], categorical: str, classes: list[str], trees: int = TREES, depth: int = 30, seed: int = SEED
) -> Scorer:
    """Refits the preprocessor and a balanced forest on the labelled rows of the round."""

    def fit(labelled: DataFrame) -> Callable[[DataFrame], DataFrame]:
        figures = figures_of(labelled, numeric, categorical, label)
        preprocessor = preprocessor_of(figures, labelled, categorical)
        weighted = labelled.withColumn("_weight", class_weight(figures.labels, label)).withColumn("_class", class_index(label, classes))
        ready = written(preprocessor.transform(weighted).select("features", "_class", "_weight"), "training")
        forest = random_forest(trees, depth, seed).fit(ready)
        discard(ready)
        return lambda rows: with_top_class(forest.transform(preprocessor.transform(rows)), classes)

    return fit


def frequency_scorer(label: str, classes: list[str], cell_sets: list[list[str]]) -> Scorer:
    """Class shares among the labelled rows of the same cell, averaged over several kinds of cell.

    A cell without labelled rows has share 0 for every class.
    """

    def fit(labelled: DataFrame) -> Callable[[DataFrame], DataFrame]:
        shares = [F.count_if(F.col(label) == c) / F.count(F.lit(1)) for c in classes]
        tables = [labelled.groupBy(*cells).agg(F.array(*shares).alias(f"_shares{i}")) for i, cells in enumerate(cell_sets)]
        nothing = F.array(*[F.lit(0.0) for _ in classes])

        def score(rows: DataFrame) -> DataFrame:
            for cells, table in zip(cell_sets, tables):
                rows = rows.join(F.broadcast(table), cells, "left")  # one row per cell of a model
            total = nothing
            for i in range(len(tables)):
                total = F.zip_with(total, F.coalesce(F.col(f"_shares{i}"), nothing), lambda a, b: a + b)
            mean = F.transform(total, lambda value: value / len(tables))
            _, name, confidence = top_class(mean, classes)
            return rows.withColumns({"_pred_class": name, "_confidence": confidence})

        return score

    return fit
