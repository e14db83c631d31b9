"""Operators for preparing large text corpora: one module per operator.

Nothing else in the library imports this package. ``queries.py`` holds the
registered queries.
"""
