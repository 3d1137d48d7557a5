"""Operators of a training-data pipeline: deduplication, scans, classifiers, mixing, packing and chat rendering."""
