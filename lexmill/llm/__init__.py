"""Operators for preparing training data, and their registered queries.

Nothing outside this folder imports it. Every operator takes and returns
DataFrames; ``queries.py`` holds the registered queries and their SQL.
"""
