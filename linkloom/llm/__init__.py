"""Operators of a training-data pipeline: scans, dedup, quality, mixing, sharding and filters.

Each module holds one operator and takes and returns DataFrames.  ``queries`` registers them.
"""
