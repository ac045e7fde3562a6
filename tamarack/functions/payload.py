"""Fields out of nested payloads, JVM-side."""

from pyspark.sql import Column
from pyspark.sql import functions as F

LABEL_SCHEMA = """
    accession string,
    data struct<geneSymbol: string, alleleType: string, alleleFunctionSource: string,
                haplotypes: array<struct<name: string, functionTerm: string, pharmVarId: string, ampTier: string>>>
"""

ANNOTATION_SCHEMA = """
    input string,
    most_severe_consequence string,
    transcript_consequences array<struct<impact: string>>,
    colocated_variants array<struct<frequencies: map<string, map<string, double>>>>
"""


def first_impact(transcripts: Column) -> Column:
    """Impact of the first transcript, whichever consequence is the most severe."""
    return F.get(transcripts, 0)["impact"]


def first_frequency(colocated: Column, preferred: str = "gnomade", fallback: str = "gnomadg") -> Column:
    """Walks entries and then alleles in document order; the first map that holds either key decides."""
    no_maps = F.array().cast("array<map<string, double>>")
    maps = F.flatten(F.transform(colocated, lambda entry: F.coalesce(F.map_values(entry["frequencies"]), no_maps)))
    holders = F.filter(maps, lambda m: F.map_contains_key(m, preferred) | F.map_contains_key(m, fallback))
    # Inside a transform the map is worked out once, however often the expression names it.
    values = F.transform(holders, lambda m: F.when(F.map_contains_key(m, preferred), m[preferred]).otherwise(m[fallback]))
    return F.get(values, 0)


def first_number(raw: Column) -> Column:
    """Raw JSON text of a number or of a list of numbers -> the (first) number."""
    head = F.get(F.from_json(raw, "array<string>"), 0)
    return F.when(raw.startswith("["), head).otherwise(raw).try_cast("double")


def revel_score(json: Column) -> Column:
    return first_number(F.get_json_object(json, "$.dbnsfp.revel.score"))


def cadd_phred(json: Column) -> Column:
    """The nested score wins when present at all; an empty list there counts as present."""
    raw = F.coalesce(F.get_json_object(json, "$.dbnsfp.cadd.phred"), F.get_json_object(json, "$.cadd.phred"))
    return first_number(raw)
