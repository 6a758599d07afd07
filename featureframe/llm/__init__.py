"""Operators on text corpora: tokens, packing, duplicates, nearest vectors, toxicity, personal data, language."""
