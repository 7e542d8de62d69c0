"""Operators for preparing training data, and their queries over the sample tables.

Nothing else in the library imports this package.
"""
