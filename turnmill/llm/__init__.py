"""Operators for large-scale training-data work; nothing else in the library imports them."""
