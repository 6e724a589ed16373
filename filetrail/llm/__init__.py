"""Operators of a training-data pipeline: text, web archives, tokens and vectors."""
