"""Scoring of uploaded tables as they arrive, with the same row-wise operators as in batch."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tamarack.operators.scoring import Bundle, prediction_table, score
from tamarack.sources.stages import write_table
from tamarack.sources.tables import scoring_input

ARRIVAL = "path string, modificationTime timestamp, length long, content binary"
FILES_AT_ONCE = 100


def write_predictions(spark: SparkSession, upload: str, out: str, bundle: Bundle) -> None:
    """Scores one CSV and writes it with the published columns behind its own."""
    write_table(prediction_table(score(scoring_input(spark, upload), bundle)), out, "csv")


def score_uploads(spark: SparkSession, uploads: str, out: str, checkpoint: str, bundle: Bundle) -> StreamingQuery:
    """Scores every CSV that has landed in ``uploads`` and not been scored yet, then stops.

    The stream carries only the names of the files; each is read by its own header, as in batch, since uploads may
    order their columns as they like and have more of them. A file's predictions go to a folder of its name, which a
    repeated batch overwrites.
    """
    arriving = spark.readStream.format("binaryFile").schema(ARRIVAL).option("maxFilesPerTrigger", FILES_AT_ONCE).load(uploads).select("path")

    def scored(batch: DataFrame, _: int) -> None:
        for row in batch.collect():  # FILES_AT_ONCE names at most
            write_predictions(batch.sparkSession, row["path"], f"{out}/{row['path'].rpartition('/')[2]}", bundle)

    return arriving.writeStream.foreachBatch(scored).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
