"""Operators for preparing training corpora.

Nothing else in the library imports this subpackage. Every operator takes and returns
DataFrames; ``queries`` applies each to its table with production parameters.
"""
