"""Operators for preparing training data: language, duplicates, scoring, secrets, contamination, tokens."""
