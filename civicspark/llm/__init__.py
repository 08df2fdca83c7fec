"""Operators of a training-data pipeline: extraction, tokens, near duplicates, screening, packing."""
