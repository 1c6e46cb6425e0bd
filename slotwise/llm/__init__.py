"""Operators of a training-data pipeline over the tables documents, pages, benchmark, labels and conversations.

Nothing else in the library imports this subpackage. Operators are in modules of their own, the registered queries
and their SQL twins in `queries`.
"""
