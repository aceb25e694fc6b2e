"""Operators of a training-data pipeline (fingerprints, dedup, filters, mixing, sharding) on Spark DataFrames."""
