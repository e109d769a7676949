"""Antibody-peptide analytics on Spark DataFrames."""
