"""Operators that prepare text for model training. Nothing outside this package imports it."""
