"""Operators for preparing training data: ten methods, their queries and a pipeline."""
