"""What operators with Python tasks need of a session."""

from pyspark.sql import SparkSession

from tamarack.session import ship_package, tune

#: Rows go to Python in batches of so many bytes: a batch of long texts would otherwise take a worker's memory.
BATCH_BYTES = 2 << 20


def prepare(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    ship_package(spark)
    return tune(spark)
