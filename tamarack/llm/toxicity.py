"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, votes, calibration.

1. Examples: a bounded sample of the labelled rows, the same number of each class, one of equal texts.
2. Terms: all words of the examples; their document frequencies are counted over all documents. A term that tells the
   classes apart (chi squared) weighs more, and none weighs nothing.
3. The index holds the examples in blocks: for each term its postings per block and their largest weight. Terms of many
   examples are multiplied out for all of them. Of a text's other terms, those of the largest bounds are scored at once;
   the rest, which together add little, are scored only in blocks whose best example could still reach the last
   neighbour by the blocks' largest weights. So neighbours are exact.
4. Neighbours vote by similarity. A logistic curve, fitted on the examples' own votes (each without itself) and
   weighted to the classes' real shares, makes the vote a probability.

The driver keeps the sample in its terms (bounded by rows and by characters), their frequencies and the examples' votes.

Rows: null and empty texts, like texts without any term, get the score of no vote; repeated rows are scored alike;
labels without a verdict are ignored, and a document that is labelled toxic once is; ties of neighbours go to the
smaller example; without labels of both classes no text is toxic (score 0); other columns are ignored.
"""

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarack.llm.scratch import Scratch
from tamarack.llm.textops import Words
from tamarack.llm.workers import prepare


@dataclass(frozen=True)
class Setting:
    """Sizes of the model; none depends on the data."""

    examples_per_class: int = 2000
    characters_per_class: int = 50_000_000  # of the examples' texts; those beyond, in the order of the draw, are left out
    half_chi2: float = 12.0  # of a term of half the largest class weight
    least_weight: float = 0.02  # class weight of a term that tells nothing
    common: float = 0.125  # share of the examples beyond which a term is summed for all of them
    neighbours: int = 15
    block: int = 64
    rest: float = 0.05  # share of a text's bounds that is left for the blocks


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def example_ids(labels: DataFrame, per_class: int) -> DataFrame:
    """doc_id and toxic of at most ``per_class`` rows of either class, drawn by hash."""
    settled = labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    draw = lambda y: settled.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
    return draw(0).unionAll(draw(1))


def terms_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every word."""
    words = Words(texts)
    return words.doc, words.hash


def counted(docs: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each (text, term) once, in order, and how often it is there."""
    kinds, numbers = np.unique(terms, return_inverse=True) if terms.dtype == np.uint64 else (None, terms)
    width = int(numbers.max(initial=0)) + 1
    docs, terms = np.divmod(np.sort(docs * width + numbers), width)
    terms = terms if kinds is None else kinds[terms]
    first = np.ones(len(docs), bool)
    first[1:] = (docs[1:] != docs[:-1]) | (terms[1:] != terms[:-1])
    starts = np.flatnonzero(first)
    return docs[starts], terms[starts], np.diff(np.append(starts, len(docs)))


class Vocabulary:
    """Term numbers of hashes. A table of bits over the lowest of theirs turns most words away at once."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes.view(np.uint64))
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(self.hashes & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def numbers(self, docs: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        some = self.maybe[(terms & np.uint64((1 << 22) - 1)).astype(np.int64)]
        docs, terms = docs[some], terms[some]
        at = np.minimum(np.searchsorted(self.hashes, terms), len(self.hashes) - 1)
        here = self.hashes[at] == terms
        return docs[here], at[here]

    def counts(self, texts: list[str | None]):
        return counted(*self.numbers(*terms_of(texts)))


def class_weights(owner: np.ndarray, terms: np.ndarray, toxic: np.ndarray, size: int, how: Setting) -> np.ndarray:
    """A weight above 0 for every term, the more it differs between the classes of the examples."""
    n1, n0 = toxic.sum(), (1 - toxic).sum()
    a, n = np.bincount(terms, toxic[owner], size), np.bincount(terms, minlength=size)
    b = n - a
    chi2 = (n1 + n0) * (a * (n0 - b) - b * (n1 - a)) ** 2 / np.maximum(n * (n1 + n0 - n) * n1 * n0, 1)
    return how.least_weight + chi2 / (chi2 + how.half_chi2)


def document_frequencies(documents: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, int]:
    """Over all documents: in how many each term is, and how many there are. A task hands on one row per term."""

    def tally(batches):
        seen, n = np.zeros(len(vocabulary.hashes), np.int64), 0
        for batch in batches:
            _, terms, _ = vocabulary.counts(batch["text"].to_pylist())
            seen += np.bincount(terms, minlength=len(seen))
            n += len(batch)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array([*some, -1], pa.int64()), pa.array([*seen[some], n], pa.int64())], ["term", "n"])

    tallied = documents.select("text").mapInArrow(tally, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # one row per term
    term, n = tallied["term"].to_numpy(), tallied["n"].to_numpy()
    out = np.zeros(len(vocabulary.hashes), np.int64)
    out[term[term >= 0]] = n[term >= 0]
    return out, int(n[term < 0].sum())


#: Postings that a step of the search takes up at once, a single text's aside.
STEP = 1 << 18


class Index:
    """Block-max inverted index of example vectors (example, term, weight), each of length 1."""

    def __init__(self, example: np.ndarray, term: np.ndarray, weight: np.ndarray, terms: int, how: Setting):
        self.examples, self.size, self.rest = int(example.max(initial=-1)) + 1, how.block, how.rest
        self.blocks = -(-self.examples // how.block)
        many = np.bincount(term, minlength=terms) > how.common * self.examples
        self.row = np.where(many, np.cumsum(many) - 1, -1)  # of a common term among its like
        often = many[term]
        self.dense = np.zeros((int(many.sum()), self.examples))
        self.dense[self.row[term[often]], example[often]] = weight[often]
        example, term, weight = example[~often], term[~often], weight[~often]
        order = np.lexsort((example, term))
        self.example, self.weight, term = example[order], weight[order], term[order]
        block = self.example // how.block
        first = np.ones(len(term), bool)
        first[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        self.starts = np.flatnonzero(first)  # of the postings of one term in one block
        self.ends = np.append(self.starts[1:], len(term))
        self.block = block[self.starts]
        self.most = np.maximum.reduceat(self.weight, self.starts) if len(term) else self.weight
        self.runs_of = np.searchsorted(term[self.starts], np.arange(terms + 1))
        self.of_term = np.searchsorted(term, np.arange(terms + 1))
        self.bound = np.zeros(terms)
        np.maximum.at(self.bound, term, self.weight)

    def nearest(self, docs: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int, k: int, without: np.ndarray | None = None):
        """For each of ``n`` texts (entries in their order) the ``k`` most similar examples, best first, and their cosines.

        Fewer if fewer share a term; ``without`` names an example per text that is left out.
        """
        postings = np.bincount(docs, self.of_term[terms + 1] - self.of_term[terms], n) + self.examples
        step = (np.cumsum(postings) // STEP).astype(np.int64)
        ends = np.searchsorted(docs, np.arange(n + 1))
        found, cosines = [], []
        for first in np.flatnonzero(np.diff(step, prepend=-1)):
            last = int(np.searchsorted(step, step[first], "right"))
            own = slice(ends[first], ends[last])
            for e, s in self._nearest(docs[own] - first, terms[own], weights[own], last - first, k, None if without is None else without[first:last]):
                found.append(e)
                cosines.append(s)
        return found, cosines

    def _nearest(self, docs, terms, weights, n, k, without):
        common = self.row[terms] >= 0
        query = np.zeros((n, len(self.dense)))
        query[docs[common], self.row[terms[common]]] = weights[common]
        scores = query @ self.dense
        docs, terms, weights = docs[~common], terms[~common], weights[~common]
        bound = weights * self.bound[terms]
        order = np.lexsort((-bound, docs))
        docs, terms, weights, bound = docs[order], terms[order], weights[order], bound[order]
        totals = np.bincount(docs, bound, n)
        ahead = np.cumsum(bound) - bound - np.concatenate([[0], np.cumsum(totals)])[docs]
        first = ahead < (1 - self.rest) * totals[docs]  # the largest bounds, up to their share
        at = self.of_term[terms[first]], self.of_term[terms[first] + 1] - self.of_term[terms[first]]
        self._add(scores, docs[first], weights[first], *at)
        if without is not None:
            scores[np.arange(n), without] = -np.inf
        # The rest: where a block's bound lets its best example reach the last neighbour so far.
        last = -np.partition(-scores, k - 1, axis=1)[:, k - 1] if self.examples >= k else np.zeros(n)
        docs, terms, weights = docs[~first], terms[~first], weights[~first]
        counts = self.runs_of[terms + 1] - self.runs_of[terms]
        runs, owner = _ranges(self.runs_of[terms], counts), np.repeat(np.arange(len(terms)), counts)
        reach = np.bincount(docs[owner] * self.blocks + self.block[runs], weights[owner] * self.most[runs], n * self.blocks).reshape(n, self.blocks)
        best = np.maximum.reduceat(scores, np.arange(0, self.examples, self.size), axis=1)
        open_blocks = (best + reach) * (1 + 1e-12) >= last[:, None]
        some = open_blocks[docs[owner], self.block[runs]]
        runs, owner = runs[some], owner[some]
        self._add(scores, docs[owner], weights[owner], self.starts[runs], self.ends[runs] - self.starts[runs])

        scores = np.minimum(scores, 1.0)
        last = -np.partition(-scores, k - 1, axis=1)[:, k - 1] if self.examples >= k else np.zeros(n)
        doc, example = np.nonzero((scores >= last[:, None]) & (scores > 0))
        score = scores[doc, example]
        order = np.lexsort((example, -score, doc))
        starts = np.searchsorted(doc, np.arange(n + 1))
        for a, b in zip(starts, starts[1:]):
            chosen = order[a:min(b, a + k)]
            yield example[chosen], score[chosen]

    def _add(self, scores, docs, weights, starts, counts) -> None:
        """Adds postings, given as ranges, to the texts' scores."""
        at = _ranges(starts, counts)
        place = np.repeat(docs * self.examples, counts) + self.example[at]
        scores += np.bincount(place, np.repeat(weights, counts) * self.weight[at], scores.size).reshape(scores.shape)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0] .. starts[0]+counts[0]-1, starts[1] .., behind each other."""
    total = int(counts.sum())
    return np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(total) if total else np.zeros(0, np.int64)


def vectors(docs: np.ndarray, terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF weights of (text, term) entries in the order of texts, each text's of length 1."""
    weight = (1 + np.log(counts)) * idf[terms]
    square = np.bincount(docs, weight * weight)
    return weight / np.sqrt(square[docs])


def vote(toxic: np.ndarray, cosines: np.ndarray) -> float:
    """Log odds of the neighbours' labels, by the square of their cosines; half a vote for each class besides."""
    weight = cosines * cosines
    yes = float(weight @ toxic)
    return float(np.log((yes + 0.05) / (float(weight.sum()) - yes + 0.05)))


def fitted_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton steps; the slope is held a little."""
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(slope * x + offset)))
        g = np.array([weight @ ((p - y) * x) + 1e-3 * slope, weight @ (p - y) + 1e-3 * offset])
        v = weight * p * (1 - p)
        h = np.array([[v @ (x * x) + 1e-3, v @ x], [v @ x, v.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        slope, offset = slope - step[0], offset - step[1]
        if abs(step).max() < 1e-9:
            break
    return float(slope), float(offset)


@dataclass
class Model:
    vocabulary: Vocabulary
    idf: np.ndarray  # by the class weights
    index: Index | None  # built where it is used
    sample: tuple[np.ndarray, np.ndarray, np.ndarray] | None  # of the examples, in order: numbers of terms, terms, counts
    ids: np.ndarray
    toxic: np.ndarray
    slope: float
    offset: float
    how: Setting

    def __getstate__(self):
        """Small, as each task's machine gets it: the vocabulary and the index are made again there."""
        sample = [zlib.compress(a.astype(np.int32).tobytes(), 1) for a in self.sample]
        return self.__dict__ | {"vocabulary": self.vocabulary.hashes, "index": None, "sample": sample}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.vocabulary = Vocabulary(state["vocabulary"])
        sizes, terms, counts = (np.frombuffer(zlib.decompress(b), np.int32).astype(np.int64) for b in state["sample"])
        self.sample = None  # the index holds it from here on
        owner = np.repeat(np.arange(len(sizes)), sizes)
        self.index = Index(owner, terms, vectors(owner, terms, counts, self.idf), len(self.idf), self.how)

    def voted(self, texts: list[str | None], without: np.ndarray | None = None):
        """Vote, numbers of the neighbours and cosines of each text."""
        docs, terms, counts = self.vocabulary.counts(texts)
        found, cosines = self.index.nearest(docs, terms, vectors(docs, terms, counts, self.idf), len(texts), self.how.neighbours, without)
        return np.array([vote(self.toxic[f], c) for f, c in zip(found, cosines)]), found, cosines


def sampled_examples(documents: DataFrame, labels: DataFrame, how: Setting) -> DataFrame:
    """number, doc_id, toxic and text of the examples; one of equal texts."""
    wanted = example_ids(labels, how.examples_per_class).withColumnRenamed("doc_id", "_id")
    # The sample is bounded by its parameter, so it is broadcast, and so its windows are small.
    sampled = documents.select("doc_id", "text").join(F.broadcast(wanted), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "toxic")
    once = sampled.groupBy(F.xxhash64("text").alias("same")).agg(F.min(F.struct("doc_id", "toxic", "text")).alias("r")).select("r.*")
    drawn = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    within = once.withColumn("characters", F.sum(F.length("text")).over(drawn)).where(F.coalesce("characters", F.lit(0)) <= how.characters_per_class)
    return within.select((F.row_number().over(Window.orderBy("toxic", "doc_id", F.xxhash64("text"))) - 1).alias("number"), "doc_id", "toxic", "text")


def fit(documents: DataFrame, labels: DataFrame, how: Setting = Setting()) -> Model | None:
    """None where the examples do not hold both classes, or no term."""
    spark = prepare(documents.sparkSession)
    scratch = Scratch(spark, "toxicity")
    examples = scratch.write(sampled_examples(documents, labels, how), "examples")

    def entries(batches):
        for batch in batches:
            docs, terms, counts = counted(*terms_of(batch["text"].to_pylist()))
            ends = np.searchsorted(docs, np.arange(len(batch) + 1))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int64())) for v in (terms.view(np.int64), counts)]
            yield pa.RecordBatch.from_arrays([batch["number"], batch["doc_id"], batch["toxic"], *lists], ["number", "doc_id", "toxic", "terms", "counts"])

    rows = examples.mapInArrow(entries, "number int, doc_id long, toxic int, terms array<long>, counts array<long>").toArrow()  # the sample, in its terms
    rows = rows.sort_by("number").combine_chunks()
    ids, toxic = rows["doc_id"].to_numpy(), rows["toxic"].to_numpy().astype(np.float64)
    owner = np.repeat(np.arange(len(ids)), pa.compute.list_value_length(rows["terms"]).to_numpy())
    hashes, counts = (pa.compute.list_flatten(rows[c]).to_numpy() for c in ("terms", "counts"))
    if len(np.unique(toxic)) < 2 or not len(hashes):
        return None
    vocabulary = Vocabulary(np.unique(hashes))
    terms = np.searchsorted(vocabulary.hashes, hashes.view(np.uint64))
    seen, total = document_frequencies(documents, vocabulary)
    order = np.lexsort((terms, owner))
    owner, terms, counts = owner[order], terms[order], counts[order]
    idf = (np.log((total + 1) / (seen + 1)) + 1e-9) * class_weights(owner, terms, toxic, len(seen), how)
    model = Model(vocabulary, idf, None, (np.bincount(owner, minlength=len(ids)), terms, counts), ids, toxic, 1.0, 0.0, how)
    shared = spark.sparkContext.broadcast(model)

    def own_votes(batches):
        for batch in batches:
            votes, _, _ = shared.value.voted(batch["text"].to_pylist(), batch["number"].to_numpy())
            yield pa.RecordBatch.from_arrays([batch["number"], pa.array(votes, pa.float64())], ["number", "vote"])

    # One row per example. Shuffled, since the sample lies in few files.
    voted = examples.repartition(spark.sparkContext.defaultParallelism).mapInArrow(own_votes, "number int, vote double").toArrow().sort_by("number")
    shares = labels.where("toxic is not null").where(~held_out(F.col("doc_id"))).agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0]
    weight = np.where(toxic > 0, shares / toxic.sum(), (1 - shares) / (1 - toxic).sum()) * len(ids)
    model.slope, model.offset = fitted_curve(voted["vote"].to_numpy(), toxic, weight)
    return model


def scored(documents: DataFrame, model: Model | None) -> DataFrame:
    """The table with ``_score``, ``_neighbours`` and ``_cosines``, replacing columns of these names: one pass, no shuffle."""
    documents = documents.drop("_score", "_neighbours", "_cosines")
    names = documents.columns
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded by its Setting

    def score(batches):
        for batch in batches:
            model = shared.value
            score, near, cosines = np.zeros(len(batch)), [[]] * len(batch), [[]] * len(batch)
            if model is not None:
                votes, near, cosines = model.voted(batch["text"].to_pylist())
                score = 1 / (1 + np.exp(-(model.slope * votes + model.offset)))
                near = [model.ids[f] for f in near]
            extra = [pa.array(score, pa.float64()), pa.array(near, pa.list_(pa.int64())), pa.array(cosines, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*names, "_score", "_neighbours", "_cosines"])

    schema = documents.select("*", F.lit(0.0).alias("_score"), F.array().cast("array<long>").alias("_neighbours"), F.array().cast("array<double>").alias("_cosines")).schema
    return documents.mapInArrow(score, schema)
