"""Embedding near-dedup by product quantisation.

1. Vectors are brought to length 1; equal ones are one *node* from here on.
2. Coarse lists: each half of a vector has a codebook, and a list is a pair of its centroids, so lists can follow the
   number of vectors while the codebooks, fitted on a bounded sample, stay small. Every vector is in one list and
   visits the nearest ones. How many follows from the data: a sample of vectors is compared with all rows, and the
   visits are as many as find ``recall`` of their links nearest the threshold, and of partners made at the threshold.
3. Within a list, residual codes per subspace and lookup tables per visitor give asymmetric distances. A member is
   compared exactly unless distance and its own quantisation error prove it too far: no link is lost here.
4. Exact cosines in double precision decide. A pair counts for both sides also if only one visits the other's list. A
   list's members and visitors are worked off in blocks, so a hot list is many tasks; pairs are never written out.

Vectors of different lengths never link. Each usual length has codebooks of its own; the vectors of a rare length are one
list, in which all are compared exactly, block by block.

Rows: vectors that are null, empty, zero, or hold null or non-finite components link with nothing; repeated rows and equal vectors are links and count each; an empty table gives an
empty one; other columns are ignored.
"""

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarack.llm.graph import components
from tamarack.llm.scratch import Scratch
from tamarack.llm.workers import prepare
from tamarack.operators.joins import attach


#: Of a list's number, the bits that tell it from others of the same length.
LIST_BITS = 32


@dataclass(frozen=True)
class Setting:
    threshold: float = 0.9
    per_list: int = 256  # vectors wanted per list
    usual: int = 1000  # a length that one in so many vectors has gets codebooks,
    least_coded: int = 4096  # and so does one of so many vectors
    most_centroids: int = 4096  # of each half
    sample_per_centroid: int = 64  # the sample is centroids x this, 262,144 at most
    codewords: int = 64
    subspace: int = 8  # dimensions of one
    nearest: int = 6  # centroids of each half that are combined, at least
    probes: int = 12  # lists that are visited, at least
    recall: float = 0.98  # of links at the threshold, by which further visits are added
    queries: int = 512  # vectors on which that is measured, against all rows
    partners: int = 8  # of each, those nearest the threshold
    block: int = 1024
    seed: int = 11


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision, safe for very large and very small components."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T), 0)


def centroids(x: np.ndarray, k: int, draw: np.random.Generator, rounds: int = 10) -> np.ndarray:
    """k-means; an empty cluster starts again at a random row."""
    centre = x[draw.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = np.concatenate([distances(x[i:i + 4096], centre).argmin(1) for i in range(0, len(x), 4096)])
        n = np.bincount(own, minlength=len(centre))
        for d in range(x.shape[1]):
            centre[:, d] = np.where(n > 0, np.bincount(own, x[:, d], len(centre)) / np.maximum(n, 1), centre[:, d])
        lost = np.flatnonzero(n == 0)
        centre[lost] = x[draw.integers(0, len(x), len(lost))]
    return centre


@dataclass
class Quantiser:
    halves: list[np.ndarray]
    words: list[np.ndarray]
    how: Setting

    @classmethod
    def of(cls, sample: np.ndarray, lists: int, how: Setting) -> "Quantiser":
        draw = np.random.default_rng(how.seed)
        parts = np.array_split(np.arange(sample.shape[1]), 2 if sample.shape[1] > 1 else 1)
        made = cls([centroids(sample[:, p], lists, draw) for p in parts], [], how)
        residual = sample - made.coarse(made.lists(sample)[:, 0])
        spaces = np.array_split(np.arange(sample.shape[1]), max(sample.shape[1] // how.subspace, 1))
        made.words = [centroids(residual[:, s], how.codewords, draw) for s in spaces]
        return made

    def lists(self, x: np.ndarray) -> np.ndarray:
        """Numbers of the nearest lists of each row, the nearest first: its own."""
        return np.concatenate([self._lists(x[i:i + 1024]) for i in range(0, len(x), 1024)])

    def _lists(self, x: np.ndarray) -> np.ndarray:
        near, far = [], []
        for d in self.to_halves(x):
            best = np.argsort(d, axis=1, kind="stable")[:, :max(self.how.nearest, self.how.probes)]
            near.append(best)
            far.append(np.take_along_axis(d, best, axis=1))
        if len(near) == 1:
            return near[0][:, :self.how.probes]
        # The list of the i-th and the j-th centroid has (i + 1) (j + 1) - 1 others that are no farther.
        i, j = np.indices((near[0].shape[1], near[1].shape[1])).reshape(2, -1)
        some = ((i + 1) * (j + 1) <= self.how.probes) | (np.maximum(i, j) < self.how.nearest)
        i, j = i[some], j[some]
        order = np.argsort(far[0][:, i] + far[1][:, j], axis=1, kind="stable")[:, :self.how.probes]
        return np.take_along_axis(near[0][:, i] * len(self.halves[1]) + near[1][:, j], order, axis=1)

    def to_halves(self, x: np.ndarray) -> list[np.ndarray]:
        """Distances of each row's halves to the centroids of theirs."""
        at, out = 0, []
        for half in self.halves:
            out.append(distances(x[:, at:at + half.shape[1]], half))
            at += half.shape[1]
        return out

    def visits_needed(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many lists each row of x has to visit to reach the own list of the same row of y."""
        out = np.ones(len(x), np.int64)
        for k in range(len(x)):
            far = [d[0] for d in self.to_halves(x[k:k + 1])]
            own = [d[0].argmin() for d in self.to_halves(y[k:k + 1])]
            goal = sum(d[c] for d, c in zip(far, own, strict=True)) - 1e-12
            rest = goal - far[1] if len(far) > 1 else np.array([goal])
            out[k] += np.searchsorted(np.sort(far[0]), rest).sum()
        return out

    def coarse(self, lists: np.ndarray) -> np.ndarray:
        if len(self.halves) == 1:
            return self.halves[0][lists]
        return np.concatenate([self.halves[0][lists // len(self.halves[1])], self.halves[1][lists % len(self.halves[1])]], axis=1)

    def codes(self, residual: np.ndarray) -> np.ndarray:
        at, out = 0, []
        for word in self.words:
            out.append(distances(residual[:, at:at + word.shape[1]], word).argmin(1))
            at += word.shape[1]
        return np.stack(out, axis=1)

    def decoded(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([word[codes[:, m]] for m, word in enumerate(self.words)], axis=1)

    def lookup(self, residual: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Distances of visitors (by their residuals to this list) to the coded members: sums of table entries."""
        out, at = np.zeros((len(residual), len(codes))), 0
        for m, word in enumerate(self.words):
            out += distances(residual[:, at:at + word.shape[1]], word)[:, codes[:, m]]
            at += word.shape[1]
        return np.sqrt(np.maximum(out, 0))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def fitted(nodes: DataFrame, n: int, how: Setting) -> Quantiser:
    """Codebooks from a sample of ``n`` nodes of one length, drawn by hash; its size is bounded by the Setting."""
    lists = int(min(max(np.ceil(np.sqrt(n / how.per_list)), 1), how.most_centroids))
    sample = nodes.orderBy("node").limit(lists * how.sample_per_centroid).select("vector", F.lit(1).alias("one"))

    def work(table):
        made = Quantiser.of(unit(matrix(table["vector"])), lists, how)
        flat = [b.astype("<f8") for b in [*made.halves, *made.words]]
        return pa.table({"number": pa.array(range(len(flat)), pa.int32()), "rows": pa.array([len(b) for b in flat], pa.int32()), "book": pa.array([b.tobytes() for b in flat], pa.binary())})

    made = sorted(sample.groupBy("one").applyInArrow(work, "number int, rows int, book binary").collect())
    books = [np.frombuffer(r["book"], "<f8").reshape(r["rows"], -1) for r in made]
    width = sum(b.shape[1] for b in books) // 2
    halves = 2 if width > 1 else 1
    return Quantiser(books[:halves], books[halves:], how)


def quantisers(nodes: DataFrame, how: Setting) -> dict[int, Quantiser]:
    """Of each usual length, with as many visits as it needs. The driver loops over these lengths."""
    counts = nodes.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"))
    total = nodes.count()
    usual = counts.where((F.col("n") * how.usual >= total) | (F.col("n") >= how.least_coded))
    out = {}
    for row in usual.orderBy("length").collect():
        own = nodes.where(F.size("vector") == row["length"])
        made = fitted(own, row["n"], how)
        made.how = replace(how, probes=probes_for(own, made, row["length"], how))
        out[row["length"]] = made
    return out


def probes_for(nodes: DataFrame, quantiser: Quantiser, length: int, how: Setting) -> int:
    """Visits that find ``how.recall`` of the links at the threshold: of a sample's links, and of partners made for it."""
    drawn = nodes.orderBy(F.desc("node")).limit(how.queries).select("node", "vector").collect()  # bounded by the Setting
    names, x = np.array([r["node"] for r in drawn]), unit(np.array([r["vector"] for r in drawn], np.float64))

    def work(batches):
        best = [[] for _ in names]  # cosine, node and vector of a query's links nearest the threshold
        for batch in batches:
            if not len(batch):
                continue
            y, own = unit(matrix(batch["vector"])), np.array(batch["node"].to_pylist())
            close = x @ y.T
            for q in np.flatnonzero(close.max(axis=1) >= how.threshold):
                some = np.flatnonzero(close[q] >= how.threshold)
                some = some[own[some] != names[q]]
                some = some[np.argsort(close[q][some], kind="stable")[:how.partners]]
                best[q] = sorted([*best[q], *((close[q][k], own[k], y[k]) for k in some)], key=lambda r: r[:2])[:how.partners]
        found = [(q, *r) for q, rows in enumerate(best) for r in rows]
        columns = [[r[c] for r in found] for c in range(4)]
        kinds = [pa.int64(), pa.float64(), pa.string(), pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["query", "cosine", "node", "vector"])

    links = nodes.select("node", "vector").mapInArrow(work, "query long, cosine double, node string, vector array<double>")
    first = Window.partitionBy("query").orderBy("cosine", "node")
    links = links.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= how.partners).select("query", "vector").collect()  # partners of each query
    away = np.random.default_rng(how.seed).normal(size=x.shape)
    away -= (away * x).sum(1, keepdims=True) * x
    long = np.linalg.norm(away, axis=1) > 1e-9  # vectors of one component have no such partner
    made = how.threshold * x[long] + np.sqrt(1 - how.threshold**2) * unit(away[long]) if long.any() else x[:0]
    pairs = [(x[long], made)]
    if links:
        pairs.append((x[[r["query"] for r in links]], np.array([r["vector"] for r in links], np.float64)))
    needed = [np.minimum(quantiser.visits_needed(a, b), quantiser.visits_needed(b, a)) for a, b in pairs if len(a)]
    return max([how.probes, *(int(np.quantile(n, how.recall, method="higher")) for n in needed)])


def visits(nodes: DataFrame, shared) -> DataFrame:
    """One row per node and list: node, copies, vector, lists (all of a member, else its own), list, member (is it the node's own?).

    A list's number starts with its vectors' length; a length without codebooks is one list.
    """

    def pieces(batches):
        for batch in batches:
            lengths = pa.compute.list_value_length(batch["vector"])
            for length in pa.compute.unique(lengths).to_pylist():
                quantiser = shared.value.get(length)
                same = batch.filter(pa.compute.equal(lengths, length))
                step = max(65536 // (quantiser.how.probes if quantiser else 1), 1)  # a row becomes as many as it visits lists
                for i in range(0, len(same), step):
                    yield length, quantiser, same.slice(i, step)

    def made(batches):
        for length, quantiser, batch in pieces(batches):
            lists = quantiser.lists(unit(matrix(batch["vector"]))).astype(np.int64) if quantiser else np.zeros((len(batch), 1), np.int64)
            lists = lists + (length << LIST_BITS)
            each = np.repeat(np.arange(len(batch)), lists.shape[1])
            rows = batch.take(pa.array(each))
            member = np.tile(np.arange(lists.shape[1]) == 0, len(batch))
            yield pa.RecordBatch.from_arrays(
                [rows["node"], rows["copies"], rows["vector"], pa.array([v if own else v[:1] for v, own in zip(lists[each], member, strict=True)], pa.list_(pa.int64())), pa.array(lists.ravel()), pa.array(member)],
                ["node", "copies", "vector", "lists", "list", "member"],
            )

    kind = nodes.schema["vector"].dataType.simpleString()
    return nodes.select("node", "copies", "vector").mapInArrow(made, f"node string, copies long, vector {kind}, lists array<long>, list long, member boolean")


def in_cells(rows: DataFrame, how: Setting) -> DataFrame:
    """The rows of each list by blocks of members and of visitors; every pair of blocks is a cell."""
    sizes = rows.groupBy("list").agg(F.sum(F.col("member").cast("long")).alias("members"), F.count("*").alias("visitors")).where("members > 0")
    known = rows.join(sizes, "list").withColumn("members", F.ceil(F.col("members") / how.block)).withColumn("visitors", F.ceil(F.col("visitors") / how.block))
    number = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    names = ["list", "node", "copies", "vector", "lists"]
    visitors = known.select(*names[:-1], F.slice("lists", 1, 1).alias("lists"), number("visitors").alias("there"), every("members").alias("here"), F.lit(True).alias("visits"))
    members = known.where("member").select(*names, every("visitors").alias("there"), number("members").alias("here"), F.lit(False).alias("visits"))
    return visitors.unionByName(members)


def linked(table: pa.Table, own: int, quantiser: Quantiser | None, how: Setting) -> pa.Table:
    """node, root, links of a cell: links found here of each node, in rows, and a node it hangs together with."""
    visits = table["visits"].to_numpy(zero_copy_only=False)
    empty = pa.table({"node": pa.array([], pa.string()), "root": pa.array([], pa.string()), "links": pa.array([], pa.int64())})
    if not visits.any() or visits.all():
        return empty
    guests, members = table.filter(pa.array(visits)), table.filter(pa.array(~visits))
    x, y = unit(matrix(guests["vector"])), unit(matrix(members["vector"]))
    near = np.ones((len(x), len(y)), bool)
    if quantiser is not None:
        home = quantiser.coarse(np.array([own & ((1 << LIST_BITS) - 1)]))
        codes = quantiser.codes(y - home)
        error = np.sqrt(((y - home - quantiser.decoded(codes)) ** 2).sum(1))
        reach = np.sqrt(2 - 2 * how.threshold)
        near = quantiser.lookup(x - home, codes) <= reach + error[None, :] + 1e-9
    guest_ids, member_ids = np.array(guests["node"].to_pylist()), np.array(members["node"].to_pylist())
    near &= guest_ids[:, None] != member_ids[None, :]
    left, right = np.nonzero(near)
    cosine = np.concatenate([np.einsum("ij,ij->i", x[left[i:i + 65536]], y[right[i:i + 65536]]) for i in range(0, len(left), 65536)]) if len(left) else np.zeros(0)
    close = cosine >= how.threshold
    left, right = left[close], right[close]
    if not len(left):
        return empty
    guest_copies, member_copies = guests["copies"].to_numpy(), members["copies"].to_numpy()
    guest_links = np.bincount(left, member_copies[right], len(x))
    # A member that does not visit the guest's own list learns of the link here, any other there.
    guest_home = np.array([v[0] for v in guests["lists"].to_pylist()])
    returned = (np.array(members["lists"].to_pylist())[right] == guest_home[left][:, None]).any(1)
    member_links = np.bincount(right[~returned], guest_copies[left[~returned]], len(y))
    names, number = np.unique(np.concatenate([guest_ids, member_ids]), return_inverse=True)
    links = np.bincount(number, np.concatenate([guest_links, member_links]), len(names)).astype(np.int64)
    parent = list(range(len(names)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    for a, b in np.unique(np.stack([number[left], number[len(x) + right]], axis=1), axis=0):
        a, b = root(int(a)), root(int(b))
        parent[max(a, b)] = min(a, b)
    some = sorted({*number[left].tolist(), *number[len(x) + right].tolist()})
    return pa.table({"node": pa.array(names[some].tolist(), pa.string()), "root": pa.array([str(names[root(k)]) for k in some], pa.string()), "links": links[some]})


def near_dedup(embeddings: DataFrame, how: Setting = Setting()) -> DataFrame:
    """vec_id, n_links, component_id, kept, for every row (vec_id, embedding)."""
    spark = prepare(embeddings.sparkSession)
    scratch = Scratch(spark, "embeddings")
    same = lambda v: F.concat(F.hex(F.xxhash64(v)), F.lit("-"), F.hex(F.xxhash64(F.lit(how.seed), v)))
    rows = embeddings.select("vec_id", F.col("embedding").alias("vector")).withColumn("node", F.when(usable(F.col("vector")), same("vector")))
    nodes = scratch.write(rows.where("node is not null").groupBy("node").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.first("vector").alias("vector")), "nodes")
    shared = spark.sparkContext.broadcast(quantisers(nodes, how))  # each bounded by the Setting
    visiting = scratch.write(visits(nodes, shared), "visits")

    def work(key, table):
        own = key[0].as_py()
        return linked(table, own, shared.value.get(own >> LIST_BITS), how)

    cells = in_cells(visiting, how)
    found = scratch.write(cells.groupBy("list", "there", "here").applyInArrow(work, "node string, root string, links long"), "found")
    scratch.drop("visits")
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), scratch).select(F.col("node").alias("n"), "root")
    links = found.groupBy(F.col("node").alias("n")).agg(F.sum("links").alias("links"))
    known = scratch.write(nodes.select("node", "vec_id", "copies").join(links.join(roots, "n", "full"), F.col("node") == F.col("n"), "left").select(
        "node", "vec_id", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"),
    ), "known")
    smallest = known.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    facts = scratch.write(known.where("n_links > 0").join(smallest, "root").select("node", "copies", "n_links", "component_id"), "facts")
    scratch.drop("nodes", "found", "known")
    told = attach(rows.select("vec_id", "node"), facts, "node", "copies", embeddings.count(), "vec_id")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return told.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
