"""Operators for preparing language-model training data.

Each module holds one operator with a general interface over DataFrames; the
``opN_`` queries in ``queries.py`` apply them to the standard tables.  Nothing
outside this package imports it.
"""
