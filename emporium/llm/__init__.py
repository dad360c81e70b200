"""Operators of a training-data pipeline.

Each module holds one operator with its own general interface; ``queries``
registers the thin ``opN_*`` queries.  Nothing outside this folder (but the
guarded import in ``__spark_entry__.py``) depends on it.
"""
