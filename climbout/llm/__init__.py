"""Training-data operators: deduplication, packing, scoring and filtering of text corpora on Spark."""
