"""Operators for preparing training text: one module per operator.

Nothing outside this package (but for the guarded registration in
``__spark_entry__.py`` and ``corpus_pipeline.py``) imports it.
"""
