"""Landed JSON payloads, score tracks, assembly maps and grids."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.functions.payload import ANNOTATION_SCHEMA, LABEL_SCHEMA


def label_payloads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LABEL_SCHEMA).json(path)


def annotation_payloads(spark: SparkSession, path: str, order: str = "src_ord") -> DataFrame:
    """Payloads with the position they were landed in; of several for one key the last counts."""
    return spark.read.schema(f"{ANNOTATION_SCHEMA}, {order} bigint").json(path)


def score_payloads(spark: SparkSession, path: str, key: str = "query") -> DataFrame:
    """(key, json): one JSON object per line, kept as text since its fields are scalars or lists."""
    lines = spark.read.text(path)
    return lines.select(F.get_json_object("value", f"$.{key}").alias(key), F.col("value").alias("json"))


def score_track(spark: SparkSession, path: str) -> DataFrame:
    """bedGraph rows: 0-based half-open ranges."""
    return spark.read.schema("chrom string, start0 bigint, end0 bigint, value double").csv(path, sep="\t")


ASSEMBLY_MAP_SCHEMA = (
    "chrom string, src_start bigint, src_end bigint, dst_chrom string, dst_start bigint, dst_end bigint, strand int, ord int"
)


def assembly_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ASSEMBLY_MAP_SCHEMA).csv(path, sep="\t")


def allele_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("gene string, row_idx int, col_idx int, value string").parquet(path)
