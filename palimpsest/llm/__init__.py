"""Operators for training-data pipelines, their queries and the SQL they are compared with."""
