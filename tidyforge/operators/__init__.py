"""Operators: each takes and returns DataFrames, or is a fit/transform pair."""
