"""Operators for preparing language-model training data.

Each module holds one operator with a general interface; ``catalog``
holds the thin registered queries on top of them.
"""
