"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage.  ``queries`` holds the
registered queries and their SQL; every other module is one operator with a
general interface (column names and parameters are arguments).
"""
