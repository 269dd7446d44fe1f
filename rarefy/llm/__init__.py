"""Operators of a training-data pipeline over documents, pages and labels.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
