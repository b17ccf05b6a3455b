"""Operators for preparing training corpora.

Nothing else in the library imports this subpackage; it may be removed as a
whole.  Each module holds one operator with its own interface, ``queries.py``
applies them to the tables of a data folder.
"""
