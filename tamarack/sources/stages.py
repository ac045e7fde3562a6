"""Tables between stages: write once, reuse when complete, side tables for rejected rows."""

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when the table was written to its end."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def write_table(df: DataFrame, path: str, kind: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Overwrites ``path``. Partitioned output is rebalanced first, so a hot partition value is split over tasks."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").format(kind)
    if kind == "csv":
        writer = writer.option("header", True).option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_side_table(df: DataFrame, path: str) -> bool:
    """Writes the rejected rows, only if there are any; an earlier run's table does not stay."""
    write_table(df, path)
    if not df.sparkSession.read.schema(df.schema).parquet(path).isEmpty():
        return True
    delete(df.sparkSession, path)
    return False


def delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _in_memory(leaf) -> bool:
    """Whether a leaf of the plan holds rows of its own, which neither the plan's text nor any file tells."""
    return leaf.getClass().getSimpleName() in ("LocalRelation", "LogicalRDD", "ExternalRDD", "InMemoryRelation")


def _digest_of_rows(df: DataFrame, leaf) -> str:
    """Of the rows of one leaf, in any order: how many, and two sums of their hashes."""
    spark = df.sparkSession
    rows = DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, leaf), spark)
    # By place, since names may clash; as JSON, since not every type has a hash.
    text = F.to_json(F.struct(*[F.col(f"c{i}") for i in range(len(rows.columns))]), {"ignoreNullFields": "false"}) if rows.columns else F.lit("")
    halves = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))]).select(F.sha2(text, 256).alias("d")).select(
        *[F.conv(F.substring("d", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)").alias(f"h{i}") for i in range(2)]
    )
    return str(tuple(halves.agg(F.count(F.lit(1)), F.sum("h0"), F.sum("h1")).first()))


def _whole_plan(df: DataFrame) -> tuple[str, list]:
    """The analyzed plan without the cut that printing makes at some number of fields, and its leaves."""
    plan = df._jdf.queryExecution().analyzed()
    fields, length = "spark.sql.debug.maxToStringFields", "spark.sql.maxPlanStringLength"
    spark = df.sparkSession
    before = {key: spark.conf.get(key) for key in (fields, length)}
    try:
        for key in before:
            spark.conf.set(key, 2**31 - 16)
        text = plan.canonicalized().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    leaves = plan.collectLeaves()
    return text, [leaves.apply(i) for i in range(leaves.size())]


def manifest(**inputs: object) -> list[tuple[str, str, str]]:
    """(input, part, value) of everything a stage is made from.

    Arguments as they print; of tables the digest of the whole plan, the names, sizes and times of their files, and
    digests of the rows that the plan itself holds. Code that a plan calls (a Python function) counts by its name only.
    """
    parts = []
    for name, given in inputs.items():
        if not isinstance(given, DataFrame):
            parts.append((name, "argument", repr(given)))
            continue
        text, leaves = _whole_plan(given)
        parts.append((name, "plan", hashlib.sha256(text.encode()).hexdigest()))
        context = given.sparkSession.sparkContext
        for path in sorted(given.inputFiles()):
            file = context._jvm.org.apache.hadoop.fs.Path(path)
            status = file.getFileSystem(context._jsc.hadoopConfiguration()).getFileStatus(file)
            parts.append((name, path, f"{status.getLen()} bytes, {status.getModificationTime()}"))
        parts += [(name, f"rows of leaf {i}", _digest_of_rows(given, leaf)) for i, leaf in enumerate(leaves) if _in_memory(leaf)]
    return parts


MANIFEST = "input string, part string, value string"


def reuse_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame], made_from: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """The stage as it was written, if it is complete and, where ``made_from`` is given, its manifest says the same."""
    listed = f"{path}.manifest"

    def same() -> bool:
        return is_complete(spark, listed) and sorted(map(tuple, spark.read.schema(MANIFEST).parquet(listed).collect())) == sorted(made_from)

    if not is_complete(spark, path) or made_from is not None and not same():
        delete(spark, listed)
        write_table(build(), path)
        if made_from is not None:
            write_table(spark.createDataFrame(made_from, MANIFEST).coalesce(1), listed)
    return spark.read.parquet(path)
