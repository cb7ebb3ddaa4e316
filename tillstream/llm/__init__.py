"""Operators for preparing training text: deduplication, filters, scoring, tokens and packing."""
