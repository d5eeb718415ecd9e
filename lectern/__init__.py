"""Curation of text corpora into balanced reading scripts, on Spark DataFrames."""
