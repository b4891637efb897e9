"""Operators for training-data pipelines: deduplication, quality, language, toxicity, licences, tokens, contamination."""
