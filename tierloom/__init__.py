"""Auditable text routing, classification tasks and stratified sampling on Spark DataFrames."""
