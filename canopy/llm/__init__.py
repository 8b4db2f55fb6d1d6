"""Operators for preparing language-model training data (deduplication, scoring, packing, ...)."""
