"""Operators of a training-data pipeline: dedup, scoring, filters, formatting, mixing, extraction."""
