"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade >= k) = logistic(w . x - t_k) with one weight vector for all grades and ordered thresholds t_1 < t_2 < ...; x are
the means of hashed words, of hashed byte triples and of whether a word is the one before it, so a score is a few means
of looked-up weights. The
expected grade is the sum of the tails; a tail selects.

The fit runs in one task on a bounded, documented sample of the labelled rows; scoring reads every whole text.

Rows: null and empty texts have no features and are scored by the thresholds alone; repeated rows are scored alike;
ratings without a grade are ignored, of several ratings of a document the lowest counts; where fewer than two grades
are rated every text gets the rated grade (the lowest one without ratings); an empty table gives an empty one; other
columns pass.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.textops import CHUNK, Words, mixed64
from tamarack.llm.workers import prepare


@dataclass(frozen=True)
class Setting:
    bits: int = 18  # of the hashed weights of each kind of feature
    sample: int = 8_000  # rated rows the fit reads at most
    updates: int = 900
    batch: int = 128
    rate: float = 0.5
    grades: int = 3  # 0 .. grades - 1
    seed: int = 7


KINDS = 3  # words, byte triples, whether a word is the one before


def features(texts: list[str | None], how: Setting) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind, the slots of all texts behind each other, and where each text's end."""
    mask = np.uint64((1 << how.bits) - 1)
    words = Words(texts)
    word_ends = np.searchsorted(words.doc, np.arange(1, len(texts) + 1))
    again = np.zeros(len(words.hash), np.int32)
    again[1:] = (words.doc[1:] == words.doc[:-1]) * (1 + (words.hash[1:] == words.hash[:-1]))  # 0 for a text's first word
    slots, ends, total = [np.zeros(0, np.int32)], [], 0
    for text in texts:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        for start in range(0, max(len(raw) - 2, 0), CHUNK):
            part = raw[start:start + CHUNK + 2].astype(np.uint64)
            triple = part[:-2] | part[1:-1] << np.uint64(8) | part[2:] << np.uint64(16)
            slots.append((mixed64(triple) & mask).astype(np.int32))
            total += len(triple)
        ends.append(total)
    return [((words.hash & mask).astype(np.int32), word_ends), (np.concatenate(slots), np.array(ends, np.int64)), (again, word_ends)]


def means(weights: np.ndarray, slots: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The mean weight of each text's slots; 0 for a text without any."""
    sums = np.concatenate([[0.0], np.cumsum(weights[slots], dtype=np.float64)])
    starts = np.concatenate([[0], ends[:-1]])
    return (sums[ends] - sums[starts]) / np.maximum(ends - starts, 1)


def entries(texts: list[str | None], how: Setting) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots over all kinds and their shares, once per text, and where each text's start (and the last one's end)."""
    slots, shares, bounds = [], [], [0]
    for text in texts:
        for kind, (own, _) in enumerate(features([text], how)):
            at, n = np.unique(own, return_counts=True)
            slots.append(at.astype(np.int64) + (kind << how.bits))
            shares.append(n / max(len(own), 1))
        bounds.append(bounds[-1] + sum(len(x) for x in slots[-KINDS:]))
    return np.concatenate(slots), np.concatenate(shares), np.array(bounds)


@dataclass
class Model:
    weights: np.ndarray  # one row per kind
    thresholds: np.ndarray
    how: Setting

    def tails(self, texts: list[str | None]) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..: one row per text."""
        score = sum(means(w, slots, ends) for w, (slots, ends) in zip(self.weights, features(texts, self.how), strict=True))
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -40, 40)))


def constant(grade: int, how: Setting) -> Model:
    return Model(np.zeros((KINDS, 1 << how.bits), np.float32), np.where(np.arange(how.grades - 1) < grade, -40.0, 40.0), how)


def rated(documents: DataFrame, ratings: DataFrame, how: Setting) -> DataFrame:
    """text and grade of at most ``how.sample`` rated rows, drawn by hash; ratings has doc_id and grade."""
    settled = ratings.where("grade is not null and doc_id is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    drawn = settled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(how.sample).select(F.col("doc_id").alias("_id"), "grade")
    return documents.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "grade")


def ordered(theta: np.ndarray) -> np.ndarray:
    """Thresholds from the first one and the logarithms of the steps to the next."""
    return np.concatenate([theta[:1], theta[0] + np.cumsum(np.exp(theta[1:]))])


def trained(texts: list[str | None], grades: np.ndarray, how: Setting) -> Model:
    """Adagrad on the log likelihood of each text's grade, a difference of two neighbouring tails."""
    slots, shares, bounds = entries(texts, how)
    weights, squares = np.zeros(KINDS << how.bits), np.full(KINDS << how.bits, 1e-6)
    over = np.clip(1 - np.cumsum(np.bincount(grades, minlength=how.grades))[:-1] / len(grades), 1e-3, 1 - 1e-3)
    first = -np.log(over / (1 - over))  # thresholds that give the grades' shares
    theta, theta_squares = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 1e-2))]), np.full(len(over), 1e-2)
    draw = np.random.default_rng(how.seed)
    for _ in range(-(-how.updates * how.batch // len(grades))):
        order = draw.permutation(len(grades))
        for at in range(0, len(order), how.batch):
            rows = order[at:at + how.batch]
            n = bounds[rows + 1] - bounds[rows]
            own = np.repeat(np.arange(len(rows)), n)
            where = np.repeat(bounds[rows] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            slot, share = slots[where], shares[where]
            score = np.bincount(own, weights[slot] * share, len(rows))
            tail = 1 / (1 + np.exp(np.clip(ordered(theta)[None, :] - score[:, None], -30, 30)))
            whole = np.concatenate([np.ones((len(rows), 1)), tail, np.zeros((len(rows), 1))], axis=1)
            y, each = grades[rows], np.arange(len(rows))
            upper, lower = whole[each, y], whole[each, y + 1]
            mass, up, low = np.maximum(upper - lower, 1e-9), upper * (1 - upper), lower * (1 - lower)
            by_score = (up - low) / mass  # of the log likelihood
            by_cut = np.zeros((len(rows), len(theta)))
            some = y > 0
            by_cut[some, y[some] - 1] -= (up / mass)[some]
            some = y < how.grades - 1
            by_cut[some, y[some]] += (low / mass)[some]
            step = by_cut.mean(axis=0)
            step = np.array([step.sum(), *(step[k:].sum() * np.exp(theta[k]) for k in range(1, len(theta)))])
            theta_squares += step**2
            theta = theta + 0.05 * step / np.sqrt(theta_squares)
            touched, inverse = np.unique(slot, return_inverse=True)
            step = np.bincount(inverse, by_score[own] * share / len(rows), len(touched))
            squares[touched] += step**2
            weights[touched] += how.rate * step / np.sqrt(squares[touched])
    return Model(weights.reshape(KINDS, -1).astype(np.float32), ordered(theta), how)


def fit(documents: DataFrame, ratings: DataFrame, how: Setting = Setting()) -> Model:
    prepare(documents.sparkSession)

    def work(table):
        order = np.lexsort((table["doc_id"].to_numpy(),))
        texts, grades = [table["text"][int(i)].as_py() for i in order], table["grade"].to_numpy()[order]
        model = trained(texts, grades, how) if len(np.unique(grades)) > 1 else constant(int(grades[0]), how)
        return pa.table({"weights": [model.weights.tobytes()], "cuts": [model.thresholds.tolist()]})

    sample = rated(documents, ratings, how).withColumn("one", F.lit(1))
    made = sample.groupBy("one").applyInArrow(work, "weights binary, cuts array<double>").collect()  # one row
    return Model(np.frombuffer(made[0]["weights"], np.float32).reshape(KINDS, -1), np.array(made[0]["cuts"]), how) if made else constant(0, how)


def graded(documents: DataFrame, model: Model, select_from: int = 1, least: float = 0.5) -> DataFrame:
    """The table with ``_grade`` (expected), ``_tail`` (probability of ``select_from`` and better) and ``_kept``,
    replacing columns of these names."""
    documents = documents.drop("_grade", "_tail", "_kept")
    names = documents.columns
    shared = documents.sparkSession.sparkContext.broadcast(model)  # 3 MB, by its Setting

    def score(batches):
        for batch in batches:
            tails = shared.value.tails(batch["text"].to_pylist())
            tail = tails[:, select_from - 1]
            extra = [pa.array(tails.sum(axis=1)), pa.array(tail), pa.array(tail >= least)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*names, "_grade", "_tail", "_kept"])

    schema = documents.select("*", F.lit(0.0).alias("_grade"), F.lit(0.0).alias("_tail"), F.lit(True).alias("_kept")).schema
    return documents.mapInArrow(score, schema)
