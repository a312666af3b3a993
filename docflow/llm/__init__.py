"""Operators for training-data pipelines, each one a set of Spark jobs."""
