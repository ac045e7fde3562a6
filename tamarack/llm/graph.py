"""Connected components of edges that no machine could hold."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node, root: the smallest node each node reaches, for every node that has an edge (a, b).

    Alternates large stars and small stars: every node hands its larger neighbours, then its smaller ones, to the
    smallest it knows, until each hangs from its root. The rounds grow with the logarithm of the longest path; each is
    written, so its lineage is flat and lost executors cost a part of one round.
    """
    current = scratch.write(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges-0")
    mark, i = None, 0
    while True:
        both = current.select("a", "b").unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
        stars = both.join(large, F.col("a") == F.col("u")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        stars = scratch.write(stars, f"stars-{i}")
        small = stars.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        handed = stars.join(small, F.col("a") == F.col("u")).select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
        following = scratch.write(handed.where("a <> b").distinct(), f"edges-{i + 1}")
        new = following.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        scratch.drop(f"edges-{i}", f"stars-{i}")
        current, i = following, i + 1
        if new == mark:
            break
        mark = new
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
