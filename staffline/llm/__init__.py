"""Operators for large-scale training-data preparation.

Self-contained: nothing else in the package imports this subpackage.
``queries.py`` registers one query per operator.
"""
