"""Operators of a training-data pipeline: one module per operator.

Every module holds one operator with a general interface (DataFrame in,
DataFrame out); ``queries`` holds the thin registered queries and their SQL.
Nothing else in the library imports this subpackage.
"""
