"""Linkage operators: DataFrames in, DataFrames out."""
