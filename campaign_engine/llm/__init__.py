"""Operators of a training-data pipeline over the ``documents`` tables.

One module per operator; ``queries`` holds the thin registered queries and
``oracle`` their DuckDB SQL. Nothing else in the library imports this package.
"""
