"""Composite datasets and reports, each a function DataFrames → DataFrame."""
