"""Operators of a training-data pipeline: each takes DataFrames and returns one; nothing outside imports this."""
