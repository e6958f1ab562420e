"""Operators of a training-data pipeline, as DataFrame jobs."""
