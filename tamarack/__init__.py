"""Label-and-learn analytics on Spark: build a labelled set, enrich it, learn from it, score with it."""
