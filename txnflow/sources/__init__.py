"""Batch and stream readers. All give DataFrames with a declared schema."""
