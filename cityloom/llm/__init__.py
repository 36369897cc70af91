"""Operators for preparing text as training data; nothing outside this package and ``corpus_pipeline`` imports it."""
