"""Operators of a training-data pipeline, each one Spark jobs over `documents`-like tables."""
