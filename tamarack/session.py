"""Session settings, the shared stage folder, and tables that cut lineage."""

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators are written for. Joins are left unhinted: adaptive execution measures each
# side, broadcasts the ones that fit, and splits the partitions a hot key inflates. Splitting is kept on even
# where the next operator wants the same partitioning, since one more shuffle is cheaper than one huge task.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above; shuffle partition counts stay the cluster's choice."""
    for key, value in ADAPTIVE_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


#: What a task sorts or counts at once stays at a few hundred MB with so many narrow rows.
ROWS_PER_TASK = 500_000


@contextmanager
def dealt(spark: SparkSession, rows: int, per_task: int | None = None) -> Iterator[int]:
    """While it lasts, shuffles have a partition per ``per_task`` of the ``rows``, and not fewer than the cluster's choice.

    Partitions that adaptive execution merges and splits of files stay small too. Only what runs inside is dealt so.
    """
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(usual, -(-rows // (per_task or ROWS_PER_TASK)))
    settings = {
        "spark.sql.shuffle.partitions": str(wanted), "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(wanted),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m", "spark.sql.files.maxPartitionBytes": "32m",
    } if wanted > usual else {}
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield wanted
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a local session without one gets a temporary folder."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="tamarack-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The result survives lost executors, cuts the lineage, and can be pruned by column on every later scan.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` made, once nothing reads them any more."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tamarack-"), "tamarack")
    context.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package)))
    _shipped.add(context.applicationId)
