"""Operators for large-scale training-data pipelines (one module per operator).

Nothing outside this folder and ``corpus_pipeline.py`` imports them.
"""
