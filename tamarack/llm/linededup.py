"""Line dedup: lines whose key is found in many documents lose all their occurrences.

1. Every document gives the distinct 128-bit hashes of its line keys; they are counted per block of documents, then
   per hash. No line leaves its task as text.
2. The distinct hashes are sharded. Each shard gets a minimal perfect hash (levels of bits; a key's number is the rank
   of its bit) over arrays of fingerprints and saturated counts: about five bytes a line.
3. The blocks' hashes probe the shards, which come first in their partition; what comes back per block are the hashes
   to drop. Copies of each shard share the probes, as many as keep a copy to ``PROBES_PER_COPY``, and a hash that is in every document is probed once per
   block, so no task gets the rows of a hot line.
4. Documents stream past their block's hashes.

Every document's hashes are among those indexed, so the perfect hash has no false answer for them; fingerprints tell
hashes apart that are not.

Rows: a null or empty text is one empty line, which has no key and stays; repeated rows and doc_ids each count as a
document; an empty table gives an empty one; other columns pass.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarack.llm.scratch import Scratch
from tamarack.llm.textops import mixed64
from tamarack.llm.workers import prepare

DOCUMENTS_PER_BLOCK = 2048
KEYS_PER_SHARD = 1 << 17
#: Probes of one copy of a shard, about.
PROBES_PER_COPY = 1 << 19
LEVELS = 24
ROOM = 1.5
BLANKS = b" \t\n\x0b\x0c\r"


def line_hash(line: str) -> bytes:
    """Of the line without blanks at its ends, A-Z lower-cased; empty for a line without a key."""
    key = line.encode().lower().strip(BLANKS)
    return xxhash.xxh3_128_digest(key) if key else b""


def pairs(hashes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)


@dataclass
class PerfectHash:
    """Bits of all levels behind each other, and what no level could place (in order, by both halves)."""

    sizes: np.ndarray
    bits: np.ndarray
    rest: np.ndarray

    @staticmethod
    def spots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed64(keys[:, 0].view(np.uint64) ^ mixed64(keys[:, 1].view(np.uint64) + np.uint64(level + 1))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray) -> "PerfectHash":
        """Each level keeps the keys that have a spot of their own and hands the others down."""
        sizes, levels = [], []
        while len(keys) and len(sizes) < LEVELS:
            size = -(-int(len(keys) * ROOM) // 8) * 8 or 8
            at = cls.spots(keys, len(sizes), size)
            taken = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(taken)
            keys = keys[~taken[at]]
        rest = keys[np.lexsort((keys[:, 1], keys[:, 0]))] if len(keys) else keys
        return cls(np.array(sizes, np.int64), np.concatenate(levels) if levels else np.zeros(0, bool), rest)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """0 .. n-1 for the keys it was made of, each another; for other keys any of these, or -1."""
        ranks = np.cumsum(self.bits) - 1
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        start = 0
        for level, size in enumerate(self.sizes):
            at = start + self.spots(keys[open_], level, int(size))
            here = self.bits[at]
            out[open_[here]] = ranks[at[here]]
            open_ = open_[~here]
            start += int(size)
        if len(self.rest) and len(open_):
            place = {(int(a), int(b)): i for i, (a, b) in enumerate(self.rest)}
            base = int(ranks[-1]) + 1 if len(ranks) else 0
            for i in open_:
                found = place.get((int(keys[i, 0]), int(keys[i, 1])))
                out[i] = -1 if found is None else base + found
        return out


SHARD = "shard long, sizes array<long>, bits binary, rest binary, prints binary, counts binary"


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (keys[:, 1].view(np.uint64) >> np.uint64(48)).astype(np.uint16)


def packed_shard(shard: int, keys: np.ndarray, counts: np.ndarray, threshold: int) -> pa.Table:
    perfect = PerfectHash.of(keys)
    at = perfect.numbers(keys)
    prints, held = np.zeros(len(keys), np.uint16), np.zeros(len(keys), np.min_scalar_type(threshold))
    prints[at], held[at] = fingerprints(keys), np.minimum(counts, threshold)
    return pa.table({
        "shard": pa.array([shard], pa.int64()), "sizes": pa.array([perfect.sizes], pa.list_(pa.int64())),
        "bits": pa.array([np.packbits(perfect.bits).tobytes()], pa.binary()), "rest": pa.array([perfect.rest.astype("<i8").tobytes()], pa.binary()),
        "prints": pa.array([prints.tobytes()], pa.binary()), "counts": pa.array([held.tobytes()], pa.binary()),
    })


class Shard:
    """A shard as it is probed."""

    def __init__(self, row: dict, threshold: int):
        sizes = np.array(row["sizes"], np.int64)
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=int(sizes.sum())).astype(bool)
        self.perfect = PerfectHash(sizes, bits, np.frombuffer(row["rest"], "<i8").reshape(-1, 2))
        self.prints, self.counts = np.frombuffer(row["prints"], np.uint16), np.frombuffer(row["counts"], np.min_scalar_type(threshold))

    def found(self, keys: np.ndarray) -> np.ndarray:
        """The saturated count of each key, 0 for one that is not here."""
        at = self.perfect.numbers(keys)
        own = (at >= 0) & (self.prints[at] == fingerprints(keys))
        return np.where(own, self.counts[at], 0)


def in_blocks(documents: DataFrame) -> DataFrame:
    """block and the whole row as a struct, so no column name can clash."""
    blocks = -(-documents.count() // DOCUMENTS_PER_BLOCK) or 1
    return documents.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"), F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))


def line_hashes(blocks: DataFrame) -> DataFrame:
    """block, h1, h2, n: in how many documents of the block the line is."""

    def hashed(batches):
        for batch in batches:
            blocks, found = [], []
            for block, text in zip(batch["block"].to_pylist(), batch["text"].to_pylist(), strict=True):
                own = {line_hash(line) for line in (text or "").split("\n")} - {b""}
                found += own
                blocks += [block] * len(own)
            keys = pairs(found)
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(keys[:, 0]), pa.array(keys[:, 1])], ["block", "h1", "h2"])

    rows = blocks.select("block", F.col("row.text").alias("text")).mapInArrow(hashed, "block long, h1 long, h2 long")
    return rows.groupBy("block", "h1", "h2").agg(F.count("*").alias("n"))


def line_index(hashes: DataFrame, scratch: Scratch, threshold: int) -> tuple[DataFrame, int]:
    """The shards, and how many they are."""
    lines = scratch.write(hashes.groupBy("h1", "h2").agg(F.sum("n").alias("n")), "lines")
    shards = -(-lines.count() // KEYS_PER_SHARD) or 1

    def build(key, table):
        keys = np.stack([table["h1"].to_numpy(), table["h2"].to_numpy()], axis=1)
        return packed_shard(key[0].as_py(), keys, table["n"].to_numpy(), threshold)

    return lines.withColumn("shard", F.pmod("h1", F.lit(shards))).groupBy("shard").applyInArrow(build, SHARD), shards


def frequent_hashes(hashes: DataFrame, index: DataFrame, shards: int, threshold: int) -> DataFrame:
    """block, h1, h2 of the lines found in ``threshold`` documents or more, by probing the shards."""
    n = max(1, -(-hashes.count() // (shards * PROBES_PER_COPY)))
    copies = index.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("copy"))
    probes = hashes.select(F.pmod("h1", F.lit(shards)).alias("shard"), F.pmod(F.xxhash64("block"), F.lit(n)).alias("copy"), "block", "h1", "h2")
    mixed = copies.unionByName(probes, allowMissingColumns=True)
    # A null block is a shard: nulls come first, so every probe finds its shard loaded.
    ordered = mixed.repartition("shard", "copy").sortWithinPartitions("shard", "copy", F.col("block").asc_nulls_first())

    def probe(batches):
        loaded = None
        for batch in batches:
            loads = np.flatnonzero(batch["block"].is_null().to_numpy(zero_copy_only=False))
            for start, end in zip([-1, *loads], [*loads, len(batch)], strict=True):
                if start >= 0:
                    loaded = Shard(batch.slice(start, 1).to_pylist()[0], threshold)
                rows = batch.slice(start + 1, end - start - 1)
                if len(rows):
                    keys = np.stack([rows["h1"].to_numpy(), rows["h2"].to_numpy()], axis=1)
                    yield rows.select(["block", "h1", "h2"]).filter(pa.array(loaded.found(keys) >= threshold))

    return ordered.mapInArrow(probe, "block long, h1 long, h2 long")


def deduped_lines(documents: DataFrame, threshold: int = 10) -> DataFrame:
    """The table, its texts without the lines found in ``threshold`` documents, with ``_n_lines`` and ``_n_dropped``
    (which replace columns of these names)."""
    spark = documents.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "line-dedup")
    documents = documents.drop("_n_lines", "_n_dropped")
    blocks = in_blocks(documents)
    hashes = scratch.write(line_hashes(blocks), "hashes")
    index, shards = line_index(hashes, scratch, threshold)
    dropped = scratch.write(frequent_hashes(hashes, index, shards, threshold), "dropped")
    scratch.drop("hashes", "lines")
    mixed = blocks.unionByName(dropped, allowMissingColumns=True)
    # Rows with a hash come before the documents of their block.
    ordered = mixed.repartition("block").sortWithinPartitions("block", F.col("h1").asc_nulls_last())
    names = documents.columns

    def clean(batches):
        current, drop = None, set()
        for batch in batches:
            numbers = batch["block"].to_numpy()
            keys = np.stack([batch[c].fill_null(0).to_numpy() for c in ("h1", "h2")], axis=1).astype("<i8")
            is_key = batch["h1"].is_valid().to_numpy(zero_copy_only=False)
            rows = batch["row"]
            texts = rows.field("text")
            kept, lines, gone = [], [], []
            for i in range(len(batch)):
                if numbers[i] != current:
                    current, drop = numbers[i], set()
                if is_key[i]:
                    drop.add(keys[i].tobytes())
                    continue
                own = (texts[i].as_py() or "").split("\n")
                stay = [line for line in own if line_hash(line) not in drop]
                kept.append("\n".join(stay))
                lines.append(len(own))
                gone.append(len(own) - len(stay))
            docs = rows.filter(pa.array(~is_key))
            columns = [pa.array(kept, docs.field("text").type) if n == "text" else docs.field(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lines, pa.int64()), pa.array(gone, pa.int64())], [*names, "_n_lines", "_n_dropped"])

    schema = T.StructType([*documents.schema.fields, T.StructField("_n_lines", T.LongType()), T.StructField("_n_dropped", T.LongType())])
    return ordered.select("block", "h1", "h2", "row").mapInArrow(clean, schema)
