"""Corpus operators for training data: scoring, deduplication, filtering, packing, tokens, archives, pages.

One module per operator; ``queries`` registers one query for each. Nothing else in
the library imports this subpackage.
"""
