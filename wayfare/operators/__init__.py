"""Relational operators of the pipeline. Each takes and returns DataFrames."""
