"""Operators for text corpora: near copies, leaks, model scores, identifiers, licences, tokens, vectors.

Nothing else in the package imports this one. ``catalog`` has the queries and their SQL.
"""
