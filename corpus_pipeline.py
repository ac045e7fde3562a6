"""From raw documents to packed sequences: five stages, each written as Parquet and read again by the next."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.llm import linededup, mixing, ngramjoin, packing, toxicity
from tamarack.llm.queries import PIPELINE_MIX, domain_of, tokenizer
from tamarack.llm.scratch import Scratch


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 and more by their nearest labelled examples go."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scored(docs.select("text", F.struct("*").alias("row")), model).where("_score < 0.5").select("row.*")


def repeated_lines_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; every document stays, ``n_chars`` follows its text."""
    clean = linededup.deduped_lines(docs)
    return clean.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that similar texts link, the document with the smallest doc_id stays."""
    return ngramjoin.one_per_class(docs)


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once per epoch that its source's budget takes it in."""
    return mixing.in_epochs(mixing.mixed(docs, domain_of(F.col("source")), PIPELINE_MIX))


def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packing.packed(docs, tokenizer())


STAGES = [
    ("toxicity", toxic_out),
    ("line_dedup", repeated_lines_out),
    ("ngram_jaccard_join", near_copies_out),
    ("mixing", to_target_weights),
    ("best_fit_packing", into_sequences),
]

#: Neighbour votes and byte-pair ids are nothing SQL expresses; tests compare every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, over the documents of ``sf_dir``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if i:
            scratch.drop(STAGES[i - 1][0])
    return docs
