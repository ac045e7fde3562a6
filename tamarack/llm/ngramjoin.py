"""N-gram Jaccard join by MinHash banding: all pairs of texts whose sets of word n-grams are similar.

1. Every text gives a digest of its set of n-grams (equal sets are one *node* from here on) and the hashes of the bands
   of its MinHash signature. Rows and bands are chosen so that a pair at the threshold meets with the wanted recall.
2. Band hashes are shuffled; buckets of one node go, of buckets with the same members one stays.
3. Full n-gram sets are made again for the nodes still in a bucket and sent to it. A bucket is worked off in cells of
   two blocks of about ``BLOCK`` nodes or ``GRAMS`` n-grams, so a hot one is many tasks; a pair is verified in the first
   band it shares. A cell counts its links per node and hands on one edge per node; pairs are never written out.
4. Components of those edges are the classes.

Words are runs of ASCII letters, digits and non-ASCII characters, lower-cased; a text of fewer than n words is one
n-gram. Rows: null texts, empty texts and texts without words link with nothing; repeated rows and texts with equal
sets are links (similarity 1) and count each; class ids are smallest doc_ids, null only where no doc_id is known; an
empty table gives an empty one; other columns are ignored. Of a class that is to leave one row, the one of the smallest
doc_id stays, null last; of several such rows the one of the smallest address, then of the smallest other columns.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.graph import components
from tamarack.llm.scratch import Scratch
from tamarack.llm.textops import Words, mixed64, shingles
from tamarack.llm.workers import prepare
from tamarack.operators.joins import attach

BLOCK = 512
#: N-grams of a block, about; the sets of two blocks are one task's memory.
GRAMS = 1 << 19
#: Columns of a cell's incidence matrix worked on at once.
COLUMNS = 2048
SEED = 20


@dataclass(frozen=True)
class Bands:
    bands: int
    rows: int


def choose_bands(threshold: float, recall: float, most_hashes: int = 128) -> Bands:
    """The most rows per band, so the fewest chance meetings, for which ``recall`` at ``threshold`` is reached.

    A low threshold may need more than ``most_hashes``; it then gets bands of one row, as many as it takes.
    """
    shapes = [Bands(int(np.ceil(np.log1p(-recall) / np.log1p(-(threshold**rows)))), rows) for rows in range(1, 33)]
    return [shapes[0], *(s for s in shapes if s.bands * s.rows <= most_hashes)][-1]


@dataclass(frozen=True)
class Join:
    n: int = 5
    threshold: float = 0.8
    recall: float = 0.9995

    def bands(self) -> Bands:
        return choose_bands(self.threshold, self.recall)


def gram_sets(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the texts that have words, where their sets start, and the sets behind each other, each in order."""
    docs, hashes = shingles(Words(texts), n)
    order = np.lexsort((hashes, docs))
    docs, hashes = docs[order], hashes[order]
    first = np.ones(len(docs), bool)
    first[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
    docs, hashes = docs[first], hashes[first]
    starts = np.flatnonzero(np.diff(docs, prepend=-1))
    return docs[starts], starts, hashes


def set_digests(starts: np.ndarray, hashes: np.ndarray) -> list[bytes]:
    """128 bits of each set."""
    if not len(starts):
        return []
    halves = np.stack([np.add.reduceat(mixed64(hashes + np.uint64(1)), starts), np.bitwise_xor.reduceat(mixed64(hashes ^ np.uint64(SEED)), starts)], axis=1)
    raw = halves.astype("<u8").tobytes()
    return [raw[i:i + 16] for i in range(0, len(raw), 16)]


def band_hashes(starts: np.ndarray, hashes: np.ndarray, shape: Bands) -> np.ndarray:
    """One row per set, one hash per band."""
    draw = np.random.default_rng(SEED)
    times = draw.integers(0, 1 << 32, shape.bands * shape.rows, dtype=np.uint32) | np.uint32(1)
    plus = draw.integers(0, 1 << 32, shape.bands * shape.rows, dtype=np.uint32)
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), shape.bands), np.uint64)
    for band in range(shape.bands):
        mixed = np.full(len(starts), band, np.uint64)
        for k in range(band * shape.rows, (band + 1) * shape.rows):
            mixed = mixed64(mixed * np.uint64(31) + np.minimum.reduceat(low * times[k] + plus[k], starts))
        out[:, band] = mixed
    return out.view(np.int64)


def address_of() -> F.Column:
    """A digest of doc_id and text; rows that share it share both."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    return F.unhex(F.sha2(F.concat(doc_id, F.lit(":"), F.coalesce(F.concat(F.lit("="), F.col("text")), F.lit(""))), 256))


def addressed(documents: DataFrame) -> DataFrame:
    """doc_id, text, and an address by which a row is found again."""
    return documents.select("doc_id", "text", address_of().alias("address"))


def features(documents: DataFrame, how: Join) -> DataFrame:
    """doc_id, address, node (null for a text without words), size (of its set), bands."""
    shape = how.bands()

    def made(batches):
        for batch in batches:
            which, starts, hashes = gram_sets(batch["text"].to_pylist(), how.n)
            nodes, bands, sizes = [None] * len(batch), [None] * len(batch), np.zeros(len(batch), np.int64)
            signatures = band_hashes(starts, hashes, shape) if len(starts) else []
            for i, node, signature in zip(which, set_digests(starts, hashes), signatures, strict=True):
                nodes[i], bands[i] = node, signature
            sizes[which] = np.diff(np.append(starts, len(hashes)))
            columns = [batch["doc_id"], batch["address"], pa.array(nodes, pa.binary()), pa.array(sizes), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "address", "node", "size", "bands"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return addressed(documents).mapInArrow(made, f"doc_id {kind}, address binary, node binary, size long, bands array<long>")


def bucket_members(nodes: DataFrame) -> DataFrame:
    """band, key, members, blocks, node: the buckets of several nodes, each set of members once, at its first band."""
    spread = nodes.select("node", "size", F.posexplode("bands").alias("band", "key"))
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / GRAMS))
    meeting = spread.groupBy("band", "key").agg(
        F.count("*").alias("members"), blocks.alias("blocks"), F.bit_xor(F.xxhash64("node")).alias("one"), F.bit_xor(F.xxhash64(F.lit(SEED), "node")).alias("two"),
    ).where("members > 1")
    kept = meeting.groupBy("members", "blocks", "one", "two").agg(F.min(F.struct("band", "key")).alias("at")).select("at.band", "at.key", "members", "blocks")
    return spread.drop("size").join(kept, ["band", "key"])


def in_cells(members: DataFrame) -> DataFrame:
    """Each member once for every pair of blocks that its own block is in."""
    blocks = F.col("blocks")
    dealt = members.withColumn("block", F.pmod(F.xxhash64("node", "key"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return dealt.select("band", "key", "node", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))


def node_sets(documents: DataFrame, nodes: DataFrame, live: DataFrame, how: Join) -> DataFrame:
    """node, copies, bands, grams (a sorted set) of the live nodes, from the text of one row of each."""
    wanted = nodes.join(live, "node", "left_semi").select(F.col("address").alias("at"), "node", "copies", "bands")
    rows = addressed(documents).join(wanted, F.col("address") == F.col("at")).select("node", "copies", "bands", "text")

    def made(batches):
        for batch in batches:
            which, starts, hashes = gram_sets(batch["text"].to_pylist(), how.n)
            # Another row with the address of the wanted one has another set.
            given = batch["node"].to_pylist()
            right = [k for k, node in enumerate(set_digests(starts, hashes)) if given[which[k]] == node]
            ends = np.append(starts[1:], len(hashes))
            grams = pa.array([hashes[starts[k]:ends[k]].astype("<u8").tobytes() for k in right], pa.binary())
            own = batch.select(["node", "copies", "bands"]).take(pa.array(which[right]))
            yield pa.RecordBatch.from_arrays([*own.columns, grams], ["node", "copies", "bands", "grams"])

    return rows.mapInArrow(made, "node binary, copies long, bands array<long>, grams binary")


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many elements each set of ``left`` shares with each of ``right`` (numbers of sets)."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, there = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = there[column] > 1  # an element of one set is shared by none
    owner, column = owner[several], column[several]
    _, column = np.unique(column, return_inverse=True)
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        out += part[left] @ part[right].T
    return out


def linked(table: pa.Table, band: int, low: int, high: int, how: Join) -> pa.Table:
    """node, root, links of a cell: the links found here of each node, in rows, and a node it hangs together with."""
    nodes = table["node"].to_pylist()
    _, once = np.unique(np.array([n.hex() for n in nodes]), return_index=True)
    table = table.take(pa.array(once))
    nodes, block, copies = table["node"].to_pylist(), table["block"].to_numpy(), table["copies"].to_numpy()
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    empty = pa.table({"node": pa.array([], pa.binary()), "root": pa.array([], pa.binary()), "links": pa.array([], pa.int64())})
    if not len(left) or not len(right):
        return empty
    sets = [np.frombuffer(g, "<u8") for g in table["grams"].to_pylist()]
    size = np.array([len(s) for s in sets])
    shared = overlaps(sets, left, right)
    near = shared >= how.threshold * (size[left][:, None] + size[right][None, :] - shared)
    if low == high:
        near &= ~np.eye(len(left), dtype=bool)
    bands = np.array(table["bands"].to_pylist(), np.int64)
    for earlier in range(band):  # such a pair is counted there
        near &= bands[left, earlier][:, None] != bands[right, earlier][None, :]
    links = np.zeros(len(nodes), np.int64)
    links[left] += near @ copies[right]
    if low != high:
        links[right] += near.T @ copies[left]
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i, j in zip(*np.nonzero(near), strict=True):
        a, b = root(int(left[i])), root(int(right[j]))
        if a != b:
            parent[max(a, b)] = min(a, b)
    some = np.flatnonzero(links)
    if not len(some):
        return empty
    return pa.table({"node": pa.array([nodes[i] for i in some], pa.binary()), "root": pa.array([nodes[root(int(i))] for i in some], pa.binary()), "links": links[some]})


def jaccard_join(documents: DataFrame, how: Join = Join()) -> DataFrame:
    """doc_id, address, class, class_id, n_links, set_id, kept, for every row.

    ``n_links``: other rows at or above the threshold; ``class_id``: smallest doc_id that links lead to; ``set_id``:
    smallest doc_id with the same n-grams; ``kept``: the row's doc_id is its class_id; ``class`` is the same for the
    rows of a class, with or without doc_ids, and for no others; null for a text without words.
    """
    scratch = Scratch(prepare(documents.sparkSession), "ngram-join")
    rows = scratch.write(features(documents, how), "features")
    nodes = scratch.write(rows.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("set_id"), F.min("address").alias("address"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("bands").alias("bands"),
    ), "nodes")
    members = scratch.write(bucket_members(nodes), "members")
    sets = node_sets(documents, nodes, members.select("node").distinct(), how)
    cells = in_cells(members).join(sets, "node")

    def work(key, table):
        band, _, low, high = (k.as_py() for k in key)
        return linked(table, band, low, high, how)

    found = scratch.write(cells.groupBy("band", "key", "low", "high").applyInArrow(work, "node binary, root binary, links long"), "found")
    scratch.drop("members")
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), scratch).select(F.col("node").alias("n"), "root")
    links = found.groupBy(F.col("node").alias("n")).agg(F.sum("links").alias("links"))
    known = nodes.select("node", "set_id", "copies").join(links.join(roots, "n"), F.col("node") == F.col("n"), "left").select(
        "node", "set_id", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"),
    )
    known = scratch.write(known, "known")
    smallest = known.groupBy("root").agg(F.min("set_id").alias("class_id"))
    facts = scratch.write(known.where("n_links > 0").join(smallest, "root").select("node", "copies", "set_id", "n_links", "class_id", F.col("root").alias("class")), "facts")
    scratch.drop("nodes", "found", "known")
    told = attach(rows.select("doc_id", "address", "node"), facts, "node", "copies", rows.count(), "address")
    class_id = F.when(F.col("n_links").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    set_id = F.when(F.col("n_links").isNull(), F.col("doc_id")).otherwise(F.col("set_id"))
    return told.select(
        "doc_id", "address", F.coalesce("class", "node").alias("class"), class_id.alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), set_id.alias("set_id"),
        F.col("doc_id").eqNullSafe(class_id).alias("kept"),
    )


def one_per_class(documents: DataFrame, how: Join = Join()) -> DataFrame:
    """The table with one row of each class, and all rows without words."""
    scratch = Scratch(prepare(documents.sparkSession), "one-per-class")
    rows = scratch.write(jaccard_join(documents, how).select("doc_id", "address", "class"), "rows")
    first = rows.where("class is not null").groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "address")).alias("first")).select("first.address")
    copies = rows.groupBy(F.col("address").alias("at")).agg((F.count("*") > 1).alias("_several"))
    chosen = first.join(copies, F.col("address") == F.col("at")).select(F.col("at").alias("_at"), "_several")
    wordless = rows.where("class is null").select(F.col("address").alias("_at"), F.lit(False).alias("_several")).distinct()
    stays = scratch.write(chosen.unionAll(wordless), "stays")
    scratch.drop("rows")
    names = documents.columns
    whole = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)])
    kept = documents.select(whole.alias("_row"), address_of().alias("_address")).join(stays, F.col("_address") == F.col("_at"))
    if not stays.where("_several").isEmpty():  # equal rows: combined before the shuffle, however many
        kept = scratch.write(kept, "kept")
        one = kept.where("_several").groupBy("_address").agg(F.min_by("_row", F.to_json("_row")).alias("_row")).select("_row")
        kept = kept.where("not _several").select("_row").unionAll(one)
    return kept.select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(names)])
