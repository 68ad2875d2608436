"""Operators of a training-data pipeline: one module per operator, each with a general interface, and
the thin registered queries (``queries.py``). Nothing else in the library imports this subpackage."""
