"""Text tables with a known or a discovered layout."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.functions.text import null_tokens_to_null
from tamarack.functions.vocab import ASSEMBLY, VARIANT_COLUMNS, WIDE_PANEL
from tamarack.operators.filters import in_panel, mentions_any


def read_text_table(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """All columns as strings, names from the header, published null tokens read as null."""
    raw = spark.read.csv(path, sep=sep, header=True, inferSchema=False, escape='"', multiLine=False)
    return raw.select([null_tokens_to_null(F.col(f"`{name}`")).alias(name) for name in raw.columns])


def variants(spark: SparkSession, path: str, panel: list[str] = WIDE_PANEL, assembly: str = ASSEMBLY) -> DataFrame:
    """Panel rows of one assembly, with the known columns the file has.

    A gzip file is one task however large it is: the panel rows are spread out right after the filter.
    """
    table = read_text_table(spark, path)
    present = [name for name in VARIANT_COLUMNS if name in table.columns]
    rows = table.select([F.col(f"`{name}`") for name in present]).filter(
        in_panel(F.col("GeneSymbol"), panel) & (F.col("Assembly") == assembly)
    )
    return rows.hint("rebalance") if path.endswith(".gz") else rows


def gene_column(columns: list[str]) -> str:
    named = [name for name in columns if "gene" in name.lower()]
    if not named:
        raise ValueError(f"no column named after a gene among {columns}")
    return named[0]


def bulk_table(spark: SparkSession, path: str, panel: list[str]) -> DataFrame:
    """Rows whose gene column (found by name) mentions a panel symbol."""
    table = read_text_table(spark, path)
    return table.filter(mentions_any(F.col(f"`{gene_column(table.columns)}`"), panel))


def typed_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Re-read of a written CSV with a fixed schema; columns are matched by name."""
    raw = read_text_table(spark, path, ",")
    wanted = spark.createDataFrame([], schema).schema
    return raw.select([F.col(f"`{field.name}`").try_cast(field.dataType).alias(field.name) for field in wanted if field.name in raw.columns])


SCORING_SCHEMA = (
    "Name string, GeneSymbol string, most_severe_consequence string, vep_impact string, gnomad_af double, "
    "phylop100way double, gerp_score double"
)


def scoring_input(spark: SparkSession, path: str) -> DataFrame:
    """All uploaded columns, the documented ones typed; a missing number stays null. See ``filters.require_columns``."""
    raw = read_text_table(spark, path, ",")
    types = {field.name: field.dataType for field in spark.createDataFrame([], SCORING_SCHEMA).schema}
    return raw.select([F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in raw.columns])
