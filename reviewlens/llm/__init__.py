"""Operators of a training-data pipeline: extraction, archives, filters, near duplicates, packing."""
