"""Operators of a training-data pipeline: URL filters, token files, quality rules, toxicity, license
scans, near-duplicate removal, personal data, packing, benchmark decontamination and sharding.

Nothing else in the library imports this subpackage.
"""
