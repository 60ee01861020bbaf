"""Operators for large text corpora (training-data pipelines).

Nothing else in the library imports this subpackage.  ``registry`` holds the
registered queries and their SQL; every operator module has its own general
interface beside the thin query.
"""
