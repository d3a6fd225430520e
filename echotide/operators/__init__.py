"""Transforms on DataFrames: selection, enrichment, the star schema, and the measures."""
