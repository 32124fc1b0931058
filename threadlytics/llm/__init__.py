"""Operators for preparing training text: duplicates, search, packing, filters, mixing, extraction."""
