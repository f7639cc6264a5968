"""Operators of a training-data pipeline, each with its query over the driver tables.

Nothing outside this folder and `corpus_pipeline.py` imports it.
"""
