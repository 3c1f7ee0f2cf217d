"""Operators for preparing language-model training data.

One module per operator; ``queries`` registers a query for each.  Nothing
outside this subpackage imports it.
"""
