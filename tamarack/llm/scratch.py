"""Tables an operator writes on its way, in the folder that driver and executors share."""

import uuid

from pyspark.sql import DataFrame, SparkSession

from tamarack.session import shared_folder


class Scratch:
    """One folder of Parquet tables under the shared folder.

    A written table survives lost executors and cuts the lineage. ``drop`` deletes a table that no later step reads;
    what the returned DataFrame still reads stays, as a checkpoint would.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.read(df, name)

    def read(self, df: DataFrame, name: str) -> DataFrame:
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(conf).delete(path, True)
