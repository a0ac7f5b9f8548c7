"""Operators for training-data pipelines: scoring, packing, fingerprints, near-duplicates, filters.

``queries`` registers them; nothing else in the library imports this package.
"""
