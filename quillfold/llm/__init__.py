"""Operators for large training-data pipelines.

Nothing else in the library imports this package; ``queries`` registers its
queries and their SQL.
"""
