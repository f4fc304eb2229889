"""Textloom: structured text corpora as Spark DataFrames."""
