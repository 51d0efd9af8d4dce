"""Operators for preparing training text: de-duplication, scans, extraction, mixing and packing."""
