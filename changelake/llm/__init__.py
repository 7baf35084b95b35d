"""Operators of a training-data pipeline: quality, toxicity, personal data, duplicates,
tokens, contamination, licences and language. Nothing else in the library imports this."""
