"""Operators for preparing training text: extraction, quality, deduplication, packing, labelling."""
