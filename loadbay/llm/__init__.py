"""Operators for training-data pipelines.

Nothing outside this package imports it.  ``queries.py`` holds the registered
queries (``op1_...`` to ``op10_...``) and their SQL.
"""
