"""Best-fit packing of tokenised documents into sequences of at most ``CAPACITY`` tokens, by large-item matching.

Pieces longer than a third of the capacity go first: the largest takes the largest partner that fits, so at most two
share a sequence. The others, largest first, go where the remaining gap is smallest. What fits where depends on lengths
only, so the plan is made from the counts per length (``CAPACITY`` numbers at any size) and says, for runs of the pieces
of one length, in which sequences they start at which offset. Every piece finds its run by its number among the
pieces of its length, which counts per task and length give without ordering the rows of a length in one task.

Rows: a null or empty text is its end token only; repeated rows and doc_ids, and null doc_ids, are documents of their
own; an empty table gives an empty one; other columns are ignored.
"""

import json
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarack.llm.scratch import Scratch
from tamarack.llm.workers import prepare

CAPACITY = 2048
END = 0


@dataclass(frozen=True)
class ByteLevel:
    """A byte-level BPE vocabulary file of the tokenizers library, run by tiktoken.

    Both give the same ids (a test compares them); this one needs a fifth of the time. Merges of such a vocabulary
    are ranked by id. Special tokens are found in texts, as the library does by default.
    """

    path: str
    pattern: str

    @lru_cache  # once per worker
    def load(self):
        import tiktoken

        with open(self.path, encoding="utf-8") as file:
            given = json.load(file)
        # Printable stand-ins for bytes: printable ones stand for themselves, the others follow from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        special = {t["content"]: t["id"] for t in given["added_tokens"]}
        ranks = {bytes(byte[c] for c in token): rank for token, rank in given["model"]["vocab"].items() if token not in special}
        return tiktoken.Encoding("byte-level", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens=special)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` tokens: one, or whole capacities behind a shorter first piece."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    return [(0, first)] * bool(first) + [(start, capacity) for start in range(first, n, capacity)]


def cut_pieces(documents: DataFrame, tokenizer: ByteLevel, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32[, ids], and the piece's task and number among those of its length there."""
    prepare(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"] + ["ids"] * with_ids

    def cut(batches):
        encoder, task, seen = tokenizer.load(), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.append(encoder.encode_to_numpy(text.as_py() or "", allowed_special="all"), END).astype("<u4")
                for piece, (start, length) in enumerate(cuts(len(ids), capacity)):
                    own = ids[start:start + length]
                    rows.append((doc_id.as_py(), piece, start, length, zlib.crc32(own.tobytes()), task, int(seen[length]), *[own.astype(np.int32)] * with_ids))
                    seen[length] += 1
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            types = [batch.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()] + [pa.list_(pa.int32())] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long" + ", ids array<int>" * with_ids
    return documents.select("doc_id", "text").mapInArrow(cut, schema)


def packing_plan(counts: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Runs (length, first number, pieces, first sequence, offset) that place ``counts[length]`` pieces of each length.

    The pieces of a run go to consecutive sequences, one each. The number of runs depends on the capacity, not on
    the counts.
    """
    left, used, runs = [int(c) for c in counts], [0] * (capacity + 1), []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs of sequences (first, how many) that have it
    open_gaps = 0  # bit g: there are sequences with gap g
    sequences = 0

    def place(length: int, n: int, first: int, offset: int) -> None:
        runs.append((length, used[length], n, first, offset))
        used[length] += n
        left[length] -= n

    def leave(gap: int, first: int, n: int) -> None:
        nonlocal open_gaps
        if gap and n:
            gaps.setdefault(gap, []).append((first, n))
            open_gaps |= 1 << gap

    small = capacity // 3
    for length in range(capacity, small, -1):
        partner = min(length, capacity - length)
        while left[length]:
            while partner > small and left[partner] < (2 if partner == length else 1):
                partner -= 1
            if partner > small:
                n = left[length] // 2 if partner == length else min(left[length], left[partner])
                place(length, n, sequences, 0)
                place(partner, n, sequences, length)
                leave(capacity - length - partner, sequences, n)
            else:
                n = left[length]
                place(length, n, sequences, 0)
                leave(capacity - length, sequences, n)
            sequences += n
    for length in range(small, 0, -1):
        while left[length]:
            fitting = open_gaps >> length
            if fitting:
                gap = length + (fitting & -fitting).bit_length() - 1
                first, there = gaps[gap].pop()
                n = min(there, left[length])
                place(length, n, first, capacity - gap)
                leave(gap - length, first, n)
                if n < there:
                    gaps[gap].append((first + n, there - n))
                elif not gaps[gap]:
                    open_gaps &= ~(1 << gap)
            else:  # new sequences: full ones, then one with the rest
                each = capacity // length
                n, rest = divmod(left[length], each)
                for many, depth in ((n, each), (1, rest)):
                    if many and depth:
                        for k in range(depth):
                            place(length, many, sequences, k * length)
                        leave(capacity - depth * length, sequences, many)
                        sequences += many
    return np.array(sorted(runs), np.int64).reshape(-1, 5)


def packed(documents: DataFrame, tokenizer: ByteLevel, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset: where each piece of each document goes."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "packing")
    pieces = scratch.write(cut_pieces(documents, tokenizer, capacity, with_ids), "pieces")
    per_task = scratch.write(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "counts")
    counts = np.zeros(capacity + 1, np.int64)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row per length: 2048 at most
        counts[row["length"]] = row["n"]
    plan = packing_plan(counts, capacity)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = pieces.join(before, ["length", "task"]).withColumn("number", F.col("before") + F.col("nth"))
    far = 1 << 40  # more pieces of one length than any table has
    keys, shift, offsets = plan[:, 0] * far + plan[:, 1], plan[:, 3] - plan[:, 1], plan[:, 4]

    def places(batches):
        for batch in batches:
            length, number = batch["length"].to_numpy(), batch["number"].to_numpy()
            run = np.searchsorted(keys, length * far + number, side="right") - 1
            kept = batch.drop_columns(["number"])
            yield kept.append_column("sequence_id", pa.array(number + shift[run], pa.int64())).append_column("offset", pa.array(offsets[run], pa.int64()))

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.select(*names).schema)
    return numbered.select(*names, "number").mapInArrow(places, f"{kind}, sequence_id long, offset long")


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed sequences themselves, from pieces with ids."""
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))
