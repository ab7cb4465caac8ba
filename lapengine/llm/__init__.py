"""Operators of a large-scale training-data pipeline (language ID, WARC, dedup, filters, ...)."""
