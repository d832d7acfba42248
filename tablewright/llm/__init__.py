"""Operators for preparing training data: mixing, deduplication, scoring, formatting, sharding, tokens.

Nothing else in the library imports this package. ``queries`` holds the named queries over the
test tables; ``corpus_pipeline.py`` at the repository top chains five of the operators.
"""
