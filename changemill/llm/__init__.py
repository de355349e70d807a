"""Operators of a training-data pipeline: documents in, decisions, scores or sequences out."""
