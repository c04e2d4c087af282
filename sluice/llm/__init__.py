"""Operators of a training-data pipeline over the tables documents, pages and labels.

Nothing else in the library imports this subpackage; it may import the general
helpers (session, work folders).
"""
