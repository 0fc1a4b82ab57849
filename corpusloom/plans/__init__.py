"""Pipelines of operators, the query registry and its SQL."""
