"""Operators for preparing training text: scoring, search, packing, mixing, duplicates, archives."""
