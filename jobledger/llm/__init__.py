"""Operators for preparing training text: deduplication, scans, scores, mixing and token output."""
