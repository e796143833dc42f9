"""Operators for training data: one module each, and the queries that apply them.

Nothing else in the library imports this package.
"""
