"""Operators for preparing language-model training text at scale.

One module per operator, `queries.py` for the registered queries and their SQL.
Nothing else in the library imports this subpackage.
"""
