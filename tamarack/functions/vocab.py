"""Fixed values. They must equal the published ones for results to match, so they are stated as they are."""

# Gene panels.
WIDE_PANEL = [
    "CYP2D6", "CYP2C19", "CYP2C9", "CYP3A5", "CYP2B6", "CYP2A6", "CYP4F2",
    "DPYD", "TPMT", "NUDT15", "UGT1A1", "VKORC1", "SLCO1B1", "ABCG2",
]
LOCKED_PANEL = ["CYP2D6", "CYP2C19", "CYP2C9", "CYP3A5", "CYP2B6", "TPMT", "NUDT15", "UGT1A1", "SLCO1B1"]

# Gene -> accession of its label payload.
GENE_ACCESSIONS = {
    "CYP2D6": "PA128", "CYP2C19": "PA124", "CYP2C9": "PA126", "CYP3A5": "PA131", "CYP2B6": "PA123",
    "CYP2A6": "PA121", "CYP4F2": "PA27121", "DPYD": "PA145", "TPMT": "PA356", "NUDT15": "PA134963132",
    "UGT1A1": "PA420", "VKORC1": "PA133787052", "SLCO1B1": "PA134865839", "ABCG2": "PA390",
}

# Label terms that can be learnt from, and the one too rare to cross-validate.
USABLE_TERMS = ["Normal function", "Decreased function", "No function", "Increased function"]
RARE_TERM = "Increased function"
REFERENCE_ALLELE = "*1"
ASSEMBLY = "GRCh38"

# Ordinals.
IMPACT_ORDINAL = {"MODIFIER": 0, "LOW": 1, "MODERATE": 2, "HIGH": 3}
FUNCTION_ORDINAL = {"No function": 0, "Decreased function": 1, "Normal function": 2}

# Columns.
VARIANT_COLUMNS = [
    "GeneSymbol", "ClinicalSignificance", "VariationID", "Type", "Name", "ReviewStatus", "RS# (dbSNP)",
    "Chromosome", "Start", "Stop", "ReferenceAlleleVCF", "AlternateAlleleVCF", "Assembly",
]
NUMERIC_FEATURES = ["vep_impact_ordinal", "gnomad_af", "phylop100way", "gerp_score"]
CATEGORICAL_FEATURE = "most_severe_consequence"
SCORING_COLUMNS = ["Name", "GeneSymbol", "most_severe_consequence", "vep_impact", "gnomad_af", "phylop100way", "gerp_score"]
REQUIRED_SCORING_COLUMNS = ["most_severe_consequence", "vep_impact", "gnomad_af", "phylop100way", "gerp_score"]
OUTPUT_NAMES = {"_pred_class": "Predicted Class", "_confidence": "Confidence", "_top_feature": "Top Feature"}

# The texts a pandas CSV reader takes for missing.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Self-training and cross-validation defaults.
CONFIDENCE = 0.85
MAX_ROUNDS = 10
FOLDS = 5
SEED = 42
TREES = 300
LOGISTIC_ITERATIONS = 2000
PHASES = ["Phase1_Supervised_Baseline", "Phase2_SemiSupervised_Honest"]
