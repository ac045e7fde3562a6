"""Exact dedup by skew-safe combining.

1. Each map task combines its own equal texts (the map side of the first grouping): one row per distinct text.
2. These rows meet by (digest, salt, text); the salt follows the map task, so copies of a hot text spread over
   ``SALTS`` reducers, each of which gets at most one row per map task.
3. The salts' winners meet by (digest, text): at most ``SALTS`` rows per text.

Every grouping has the whole text in its key, so equal digests never pass for equal texts. Then every row learns its
winner by digest, and also by text where a digest has several texts.

Rows: null text counts as empty; repeated rows and repeated doc_ids each count as a row; of equal texts the largest
doc_id stays (null doc_ids never win over others); an empty table gives an empty table; other columns are ignored.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.llm.scratch import Scratch
from tamarack.operators.joins import attach

SALTS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """Lower-cased A-Z only; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def text_groups(rows: DataFrame) -> DataFrame:
    """digest, text, keep_id, group_size of rows (doc_id, text, digest), as described above; dealt by digest."""
    local = rows.withColumn("salt", F.spark_partition_id() % SALTS)
    salted = local.groupBy("digest", "salt", "text").agg(F.max("doc_id").alias("winner"), F.count("*").alias("n"))
    return salted.repartition("digest").groupBy("digest", "text").agg(F.max("winner").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_dedup(documents: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, for every row.

    Only groups of several rows are written and joined.
    """
    scratch = Scratch(documents.sparkSession, "exact-dedup")
    rows = documents.select("doc_id", normalised(F.col("text")).alias("text")).withColumn("digest", digest(F.col("text")))
    per_digest = text_groups(rows).groupBy("digest").agg(F.count("*").alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"))
    several = scratch.write(per_digest.where("texts > 1 or group_size > 1"), "groups")
    marked = rows.select("doc_id", "digest", sha256(F.col("text")).alias("text_sha256"))
    settled = attach(marked, several.drop("texts"), "digest", "group_size", documents.count(), "doc_id").select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"), "text_sha256", "digest",
    )
    clashing = several.where("texts > 1").select("digest")
    if not clashing.isEmpty():  # equal digests of different texts: these rows are told apart by their texts
        apart = rows.join(clashing, "digest", "left_semi")
        winners = text_groups(apart).select(F.col("digest").alias("d"), F.col("text").alias("t"), "keep_id", "group_size")
        told = apart.join(winners, (F.col("digest") == F.col("d")) & (F.col("text") == F.col("t"))).select("doc_id", "keep_id", "group_size", sha256(F.col("text")).alias("text_sha256"), "digest")
        settled = settled.join(clashing, "digest", "left_anti").unionByName(told)
    return settled.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
