"""From landed tables to the enriched gold set and the enriched unlabelled pool."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.functions import vocab
from tamarack.functions.text import chrom_name, rsid, whole_number
from tamarack.operators import enrich, intervals, keys
from tamarack.operators.filters import any_missing, in_panel, not_reference, payload_guard
from tamarack.operators.grid import allele_variants
from tamarack.operators.summaries import coverage, label_availability, terms_seen, value_counts
from tamarack.sources.stages import is_complete, manifest, reuse_or_build, write_side_table, write_table


def function_labels(payloads: DataFrame, accessions: dict[str, str] = vocab.GENE_ACCESSIONS) -> tuple[DataFrame, DataFrame]:
    """(label rows, payloads rejected because they name another gene)."""
    accepted, rejected = payload_guard(payloads, "accession", "data.geneSymbol", accessions)
    return enrich.label_rows(accepted, vocab.USABLE_TERMS), rejected


def crosswalk(cells: DataFrame, labels: DataFrame, panel: list[str] = vocab.LOCKED_PANEL) -> DataFrame:
    """(allele, variant) pairs of the panel's grids with their labels; the reference allele is dropped.

    ``src_ord`` is the grid row of the pair, so that the first allele of a key is well defined.
    """
    pairs = allele_variants(cells.filter(in_panel(F.col("gene"), panel)))
    named = pairs.filter(not_reference(F.col("allele_name"), vocab.REFERENCE_ALLELE))
    return keys.attach_labels(named, labels.select("gene", "allele_name", "function_term", "usable_label"), ["gene", "allele_name"])


def gold_set(crosswalk_rows: DataFrame, variants: DataFrame, strict: bool = False) -> DataFrame:
    """Variants whose (gene, rsid) has exactly one distinct usable label."""
    settled = keys.settled_labels(
        crosswalk_rows, ["gene", "rsid"], "function_term", "usable_label", "allele_name", ["src_ord"], strict
    ).withColumnRenamed("allele_name", "defining_allele")
    normalised = variants.withColumn("rsid_norm", rsid(F.col("`RS# (dbSNP)`")))
    same = (F.col("GeneSymbol") == F.col("gene")) & (F.col("rsid_norm") == F.col("rsid"))
    return normalised.join(settled, same, "inner")


@dataclass
class Landed:
    """The tables the enrichment reads."""

    annotations: DataFrame
    near_track: DataFrame
    blocks: DataFrame
    far_track: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return dict(vars(self))


@dataclass
class Enriched:
    rows: DataFrame
    missing_alleles: DataFrame
    missing_scores: DataFrame


def enriched(rows: DataFrame, landed: Landed) -> Enriched:
    """Annotations and conservation scores; rejected rows are kept aside, incompletely scored ones in both places."""
    annotated, missing_alleles = enrich.annotate(rows, landed.annotations)
    placed = annotated.withColumns({"_chrom": chrom_name(F.col("Chromosome")), "_position": whole_number(F.col("Start"))})
    chrom = {"chrom": chrom_name(F.col("chrom"))}
    scored = intervals.conservation(
        placed.withColumnsRenamed({"_chrom": "ucsc_chrom", "_position": "pos1"}), "ucsc_chrom", "pos1",
        landed.near_track, landed.blocks.withColumns(chrom), landed.far_track, chrom_name,
    ).drop("ucsc_chrom", "pos1")
    return Enriched(scored, missing_alleles, scored.filter(any_missing("phylop100way", "gerp_score")))


def build_gold(
    spark: SparkSession, out: str, variants: DataFrame, cells: DataFrame, payloads: DataFrame, landed: Landed,
    strict: bool = False,
) -> DataFrame:
    """The whole build, each stage written once under ``out`` and reused when it is already complete."""
    # A stage is made again when its own inputs changed or a stage that it reads was made from others.
    of_variants, of_labels = manifest(variants=variants), manifest(payloads=payloads)
    of_cross = of_labels + manifest(cells=cells)
    of_gold = of_variants + of_cross + manifest(strict=strict)
    of_full = of_gold + manifest(**landed.tables())
    panel_rows = reuse_or_build(spark, f"{out}/variants", lambda: variants, of_variants)
    made, rejected = function_labels(payloads)
    labels = reuse_or_build(spark, f"{out}/function_labels", lambda: made, of_labels)
    write_side_table(rejected, f"{out}/rejected_payloads")
    write_table(label_availability(labels, ["gene"], "usable_label"), f"{out}/label_availability")
    write_table(terms_seen(labels, ["gene"], "function_term"), f"{out}/terms_seen")

    cross = reuse_or_build(spark, f"{out}/crosswalk", lambda: crosswalk(cells, labels), of_cross)
    write_table(keys.conflicting_keys(cross, ["gene", "rsid"], "function_term"), f"{out}/ambiguous_keys")

    gold = reuse_or_build(spark, f"{out}/gold", lambda: gold_set(cross, panel_rows, strict=strict), of_gold)
    write_table(value_counts(gold, ["GeneSymbol", "function_term"]), f"{out}/gold_counts")

    result = enriched(gold, landed)
    full = reuse_or_build(spark, f"{out}/gold_enriched", lambda: result.rows, of_full)
    write_side_table(result.missing_alleles, f"{out}/missing_alleles")
    write_side_table(full.filter(any_missing("phylop100way", "gerp_score")), f"{out}/missing_scores")
    measured = ["most_severe_consequence", "gnomad_af", "phylop100way", "hg19_start", "gerp_score"]
    write_table(coverage(full, measured), f"{out}/coverage")
    return full


def build_pool(spark: SparkSession, out: str, variants: DataFrame, gold: DataFrame, landed: Landed) -> DataFrame:
    """Panel rows without a gold label, enriched like the gold set.

    ``gold`` is the labelled set, or what the build returned; labelled rows that the enrichment set aside are found in
    the build's own table under ``out``.
    """
    labelled = spark.read.parquet(f"{out}/gold") if is_complete(spark, f"{out}/gold") else gold
    pool = keys.unlabelled_pool(variants, labelled, ["VariationID"]).withColumn("rsid_norm", rsid(F.col("`RS# (dbSNP)`")))
    result = enriched(pool, landed)
    write_side_table(result.missing_alleles, f"{out}/pool_missing_alleles")
    return reuse_or_build(spark, f"{out}/pool_enriched", lambda: result.rows, manifest(variants=variants, labelled=labelled, **landed.tables()))
