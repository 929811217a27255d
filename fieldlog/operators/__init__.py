"""Operators of the core: each takes DataFrames and returns a lazy DataFrame."""
