"""Join rows with landed annotation and score payloads."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.functions import payload, text
from tamarack.operators.filters import split
from tamarack.operators.keys import first_per_key, lookup


def label_rows(payloads: DataFrame, terms: list[str]) -> DataFrame:
    """One row per haplotype of each accepted label payload (see ``filters.payload_guard``)."""
    rows = payloads.select("expected_gene", "accession", F.explode("data.haplotypes").alias("h"))
    return rows.select(
        F.col("expected_gene").alias("gene"), F.col("accession").alias("pa_id"), F.col("h.name").alias("allele_name"),
        F.col("h.functionTerm").alias("function_term"), F.col("h.pharmVarId").alias("pharm_var_id"),
        F.col("h.ampTier").alias("amp_tier"), F.coalesce(F.col("h.functionTerm").isin(terms), F.lit(False)).alias("usable_label"),
    )


def annotation_fields(payloads: DataFrame, order: str = "src_ord") -> DataFrame:
    """(input, most_severe_consequence, vep_impact, gnomad_af); of several payloads for a key the last one counts.

    The three fields are taken out before the shuffle, so the nested payloads never travel.
    """
    flat = payloads.filter(F.col("input").isNotNull()).select(
        "input", "most_severe_consequence",
        payload.first_impact(F.col("transcript_consequences")).alias("vep_impact"),
        payload.first_frequency(F.col("colocated_variants")).alias("gnomad_af"), order,
    )
    return first_per_key(flat, ["input"], [F.col(order).desc()]).drop(order)


def with_region(rows: DataFrame) -> DataFrame:
    return rows.withColumn(
        "region_string",
        text.region_key(F.col("Chromosome"), F.col("Start"), F.col("rsid_norm"), F.col("ReferenceAlleleVCF"), F.col("AlternateAlleleVCF")),
    )


def annotate(rows: DataFrame, payloads: DataFrame, order: str = "src_ord") -> tuple[DataFrame, DataFrame]:
    """(annotated rows, rows without a region key)."""
    keyed, missing_alleles = split(with_region(rows), F.col("region_string").isNotNull())
    return lookup(keyed, annotation_fields(payloads, order), "region_string", "input"), missing_alleles


def external_scores(payloads: DataFrame, key: str, json: str) -> DataFrame:
    """(key, revel_score, cadd_phred) from raw JSON."""
    return payloads.select(
        key, payload.revel_score(F.col(json)).alias("revel_score"), payload.cadd_phred(F.col(json)).alias("cadd_phred")
    )


def with_external_scores(rows: DataFrame, payloads: DataFrame, key: str, json: str, order: str | None = None) -> DataFrame:
    """Left lookup by ``hgvs``; keys without a payload get nulls."""
    scores = external_scores(payloads, key, json) if order is None else first_per_key(
        payloads.select(key, order, payload.revel_score(F.col(json)).alias("revel_score"), payload.cadd_phred(F.col(json)).alias("cadd_phred")),
        [key], [F.col(order).desc()],
    ).drop(order)
    named = rows.withColumn("hgvs", text.hgvs(F.col("Chromosome"), F.col("Start"), F.col("ReferenceAlleleVCF"), F.col("AlternateAlleleVCF")))
    named = named.withColumn("is_snv", text.is_snv(F.col("ReferenceAlleleVCF"), F.col("AlternateAlleleVCF")))
    return lookup(named, scores, "hgvs", key)
