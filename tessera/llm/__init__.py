"""Operators and queries for training-data preparation.

Nothing else in the library imports this sub-package; ``__spark_entry__``
adds its queries when it is present.
"""
