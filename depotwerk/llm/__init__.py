"""Operators of a training-data pipeline over ``documents``, ``labels`` and ``embeddings``.

Every operator takes a DataFrame, selects the columns it names first (further
columns never clash with its own) and returns a DataFrame keyed by the
identifier.  Nothing outside this package imports it.
"""
