"""Operators for preparing training data: deduplication, tokenising, packing, scoring, archives."""
