"""Operators for the preparation of large text collections.

Nothing else in the library imports this package; remove the folder and the rest works on.
"""
