"""Corpus curation and analytics on Spark DataFrames."""
