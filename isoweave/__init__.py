"""Isoform quantification on Spark DataFrames."""
