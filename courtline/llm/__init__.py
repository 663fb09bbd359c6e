"""Operators of a training-data pipeline over the document tables.

Nothing outside this folder (and ``corpus_pipeline.py``, which belongs to it)
imports it.  Each module holds one operator; ``queries`` registers them.
"""
