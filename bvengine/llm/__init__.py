"""Operators for training-data pipelines.

Nothing else in the library imports this package; ``queries.py`` holds the
registered queries and their SQL.
"""
