"""Training-data operators: one module per operator, queries in ``queries.py``.

Nothing else in the library imports this subpackage.
"""
