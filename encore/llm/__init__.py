"""Operators for large text corpora: filters, language, extraction, near duplicates, mixing, shards."""
