"""Operators for preparing training text: near and exact duplicates, shards, leaks,
tokens, quality, toxicity and personal data.

Every operator takes and returns DataFrames.  ``queries`` applies each one to the
``documents`` table; ``corpus_pipeline.py`` at the repository top chains five of them.
"""
