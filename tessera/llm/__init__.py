"""Operators of a training-data pipeline: one module per operator, ``registry`` holds their queries and SQL.

Nothing outside this package (and ``corpus_pipeline.py``, which counts as part
of it) imports it.
"""
