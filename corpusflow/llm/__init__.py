"""Operators of a training-data pipeline: sharding, near-duplicates, classifiers, scans, packing.

Nothing outside this folder imports it.
"""
