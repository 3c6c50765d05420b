"""Operators for preparing training text: extraction, labelling, scoring, deduplication and packing."""
