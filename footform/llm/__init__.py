"""Operators for large training-data pipelines, each a Spark job over a documents-like table."""
