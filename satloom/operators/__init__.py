"""Relational and sequence operators, each on DataFrames."""
