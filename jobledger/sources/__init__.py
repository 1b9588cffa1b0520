"""Scans of records, configuration and ranges, and the staged write."""
