"""Operators that prepare text, pages and media for model training."""
