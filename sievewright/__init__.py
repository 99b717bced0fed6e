"""Curation of instruction-tuning corpora and analysis of the runs that make them, on Spark."""
