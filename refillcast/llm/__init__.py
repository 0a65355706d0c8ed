"""Operators of a training-data pipeline: mixing, cleaning, near-duplicates, sharding, formatting.

Nothing else of the package imports this subpackage. Every operator takes and returns DataFrames;
``queries`` registers one query per operator.
"""
