"""Operators of a training-data pipeline: deduplication, filters, mixing, packing, archives."""
