"""Operators for building training data; ``registry`` has their queries."""
