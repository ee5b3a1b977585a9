"""Operators for large-scale training-data preparation.

Nothing outside this folder and ``corpus_pipeline.py`` imports it; the driver's
entry adds its queries only where it can be imported.
"""
