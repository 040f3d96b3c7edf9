"""Operators for preparing text corpora: filters, near-duplicate joins, packing, tokenizing and scoring.

Nothing else in the library imports this subpackage.
"""
