"""Operators for preparing training text: extraction, cleaning, deduplication, packing and sharding."""
