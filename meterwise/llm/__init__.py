"""Operators for a large training-data pipeline (ten of them, one module each).

Nothing outside this folder imports it except ``__spark_entry__.py`` (guarded)
and ``corpus_pipeline.py``.
"""
