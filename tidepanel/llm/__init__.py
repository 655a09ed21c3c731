"""Operators of a training-data pipeline: one module per operator.

``queries.py`` registers one query per operator, ``oracles.py`` holds the
DuckDB SQL of those that SQL can express.  Nothing else in the package
imports this subpackage.
"""
