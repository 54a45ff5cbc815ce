"""Operators for preparing training text: mixing, scans, search, dedup, filters, counts, packing and scoring."""
