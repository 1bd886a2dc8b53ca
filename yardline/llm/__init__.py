"""Operators of a training-data pipeline; their queries are in :mod:`yardline.llm.queries`."""
